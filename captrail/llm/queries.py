"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captrail.session import ship

from .common import crc_fold, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, score

    docs = table(spark, sf_dir, "documents")
    got = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece import encode, load

    return encode(table(spark, sf_dir, "documents"), load(), keep_ids=False)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit, predict

    docs = table(spark, sf_dir, "documents")
    got = predict(docs, fit(docs))
    return got.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_langs", "mixture")


def op5_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .windows import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mtree import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import digest, scan

    return digest(scan(table(spark, sf_dir, "documents")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vptree import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op11_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import digest, scan

    return digest(scan(table(spark, sf_dir, "documents")))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import audit

    return audit(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import group_variants

    return group_variants(table(spark, sf_dir, "documents"))


def shipped(query):
    """The query, after workers got the package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {f.__name__: shipped(f) for f in (op1_quality, op2_suffixes, op3_sentencepiece, op4_language, op5_windows, op6_top_k, op7_secrets, op9_minhash, op10_nearest, op11_private, op12_divergence, op13_spelling)} | {"op8_mixing": op8_mixing}
_WORDS = "coalesce(regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+'), [])"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op2_suffixes": f"""
        with d as (select row_number() over () rid, doc_id, {_WORDS.format("text")} ws from documents),
        s as (select rid, i, md5(array_to_string(ws[i:i + 49], ' ')) k from (select rid, ws, unnest(range(1, len(ws) - 48)) i from d where len(ws) >= 50)),
        r as (select rid, i from (select rid, i, count(*) over (partition by k) c from s) where c > 1),
        j as (select distinct rid, unnest(range(i, i + 50)) j from r),
        p as (select rid, min(j) - 1 f, max(j) e from (select rid, j, j - row_number() over (partition by rid order by j) isle from j) group by rid, isle)
        select doc_id, count(*) n_passages, cast(sum(e - f) as bigint) n_repeated, string_agg(concat(f, ':', e), ',' order by f) spans from p join d using (rid) group by rid, doc_id""",
    "op5_windows": f"""
        with d as (select row_number() over () rid, doc_id, {_WORDS.format("text")} ws from documents),
        s as (select rid, i, md5(array_to_string(ws[i:i + 34], ' ')) k from (select rid, ws, unnest(range(1, len(ws) - 33)) i from d where len(ws) >= 35)),
        r as (select rid, i from (select rid, i, count(*) over (partition by k) c from s) where c > 1),
        gone as (select distinct rid, unnest(range(i, i + 35)) j from r),
        w as (select rid, unnest(ws) word, unnest(range(1, len(ws) + 1)) j from d),
        kept as (select rid, count(*) n, string_agg(word, ' ' order by j) t from w anti join gone using (rid, j) group by rid)
        select doc_id, cast(len(ws) as bigint) n_words, cast(len(ws) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256 from d left join kept using (rid)""",
    "op6_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) e from embeddings where vec_id is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0)
        select query_id, cast(r as int) as "rank", vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) r from
          (select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)) where r <= 5""",
    "op8_mixing": f"""
        with d as (select doc_id, source, cast(len({_WORDS.format("text")}) as bigint) size from documents),
        n as (select count(*) n, coalesce(sum(size), 0)::bigint total from d),
        s0 as (select source, sum(size)::bigint source_size, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint weight from d group by source),
        s1 as (select *, cast(3 * source_size as double) cap from s0),
        s2 as (select *, sum(source_size) over ()::double total, coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0.0) full_before,
          sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) weight_left from s1),
        s3 as (select *, (total - full_before) / weight_left::double own, cap <= (total - full_before) / weight_left::double * weight is_full from s2),
        s4 as (select *, arg_min(own, cap / weight) filter (not is_full) over () level from s3),
        s5 as (select source, source_size, total, case when is_full or level is null then cap else level * weight end target from s4),
        marks as (select *, floor(least(1.0, sum(target) over (order by source nulls last rows unbounded preceding) / greatest(total, 1.0)) * 4611686018427387904::double)::bigint hi from s5),
        m as (select *, coalesce(lag(hi) over (order by source nulls last), 0) lo from marks),
        slots as (select (((i + 1)::hugeint * 2850178704830799621) % 4611686018427387904)::bigint u from (select unnest(range((total + 63) // 64)) i from n)),
        got as (select m.source, count(*)::bigint slots from slots join m on u >= lo and u < hi group by m.source),
        k as (select d.*, md5(concat('mix', coalesce(cast(doc_id as varchar), ''))) key from d),
        b as (select k.*, cast(concat('0x', key[1:8]) as bigint) % greatest(1, (n + 2047) // 2048) bucket from k, n),
        p as (select *, coalesce(sum(size) over (partition by source order by bucket, key, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint start from b),
        t as (select p.doc_id, p.size, m.source_size, m.target, p.source, p.start, coalesce(got.slots * 64, least(64, ceil(m.target)))::bigint reach from p join m on p.source is not distinct from m.source left join got on p.source is not distinct from got.source)
        select doc_id, size, source_size, target, cast(greatest(0, least(size, reach - start)) + greatest(0, least(size, reach - start - source_size)) + greatest(0, least(size, reach - start - 2 * source_size)) as bigint) taken, source from t""",
    "op9_minhash": f"""
        with recursive d as (select doc_id, {_WORDS.format(_LOWER)} ws from documents),
        sh as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [ws] else list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2]) end) x from d),
        n as (select doc_id, count(*) n from sh group by doc_id),
        e as (select a.doc_id p, b.doc_id q from sh a join sh b on a.x = b.x and a.doc_id <> b.doc_id join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
          group by a.doc_id, b.doc_id, na.n, nb.n having 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
        cc as (select doc_id id, doc_id reach from n union select e.q, cc.reach from cc join e on e.p = cc.id and cc.reach < e.q),
        c as (select id, min(reach) c from cc group by id)
        select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, coalesce(c.c, d.doc_id) component_id, coalesce(c.c, d.doc_id) is not distinct from d.doc_id kept from d left join n using (doc_id) left join c on c.id = d.doc_id""",
    "op10_nearest": """
        with v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) e from embeddings where vec_id is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0)
        select query_id, cast(r as int) as "rank", vec_id, score from (select *, row_number() over (partition by query_id order by score, vec_id) r from
          (select q.vec_id query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])), lambda a, b: a + b)) score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0)) where r <= 10""",
    "op12_divergence": f"""
        with d as (select row_number() over () rid, coalesce(lang, '') lang, coalesce(source, '') source, coalesce({_LOWER}, '') t from documents),
        w as (select rid, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) term from d),
        k as (select lang, term, count(*)::hugeint total from w group by lang, term having count(distinct rid) >= 30),
        v as (select lang, count(*)::hugeint v, sum(total)::hugeint n from k group by lang),
        g as (select distinct lang, source from d),
        c as (select lang, source, term, count(*)::hugeint c from w join k using (lang, term) group by lang, source, term),
        gn as (select lang, source, sum(c)::hugeint n from c group by lang, source),
        p as (select g.lang, g.source, k.term, coalesce(c, 0) c, 1 + (1000000000::hugeint * (coalesce(c, 0) + 5)) // (coalesce(gn.n, 0) + 5 * v.v) p, 1 + (1000000000::hugeint * (k.total + 5)) // (v.n + 5 * v.v) q
          from g join k using (lang) join v using (lang) left join c using (lang, source, term) left join gn using (lang, source)),
        f as (select a.lang, a.source, b.source item, sum(abs(a.p - b.p))::bigint value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        pairs as (select a.lang, a.source, 'pair' part, b.source item, coalesce(f.value, 0)::bigint value from g a join g b on a.lang = b.lang and a.source <> b.source left join f on f.lang = a.lang and f.source = a.source and f.item = b.source),
        every as (select * from pairs union all select lang, source, 'term', term, (p - q)::bigint from p where c > 0 and p > q),
        r as (select *, row_number() over (partition by lang, source, part order by value desc, item) r from every)
        select lang, source, part, item, value, cast(r as int) as "rank" from r where part = 'pair' or r <= 50""",
    "op13_spelling": f"""
        with recursive tab as (select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t),
        d as (select doc_id, regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]{{7,}}') ws from documents where text is not null),
        o as (select doc_id, w, count(*) n from (select doc_id, unnest(ws) w from d) group by doc_id, w),
        b as (select w, n, list_transform(string_split(concat(doc_id, ':', w), ''), lambda x: unicode(x)) u from o),
        h as (select w, n, xor(4294967295, list_reduce(flatten(list_transform(u, lambda x: case when x < 128 then [x::bigint] else [195::bigint, x::bigint - 64] end)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::bigint)) h from b, tab),
        m as (select case when h % 31 = 0 then concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) else w end w, n from h),
        v as (select w, sum(n)::bigint n from m where length(w) >= 7 group by w having sum(n) >= 2),
        k as (select w, i, concat(substr(w, 1, i - 1), substr(w, i + 1)) r from (select w, unnest(range(1, length(w) + 1)) i from v)),
        e as (select distinct a, b from (select x.w a, y.w b from k x join k y on x.r = y.r and x.i = y.i and x.w <> y.w union all select k.w, v.w from k join v on v.w = k.r union all select v.w, k.w from k join v on v.w = k.r)),
        s as (select e.a w, count(*) n_near, max(v.n) best from e join v on v.w = e.b group by e.a),
        t as (select e.a w, min(e.b) form from e join v on v.w = e.b join s on s.w = e.a and s.best = v.n group by e.a),
        f as (select v.w, v.n, coalesce(n_near, 0) n_near, case when best >= 10 * v.n then form end form, case when best >= 10 * v.n then best end form_n from v left join s using (w) left join t using (w)),
        up as (select w, w top, 0 k from f union all select up.w, f.form, k + 1 from up join f on f.w = up.top where f.form is not null),
        root as (select w, arg_max(top, k) root from up group by w)
        select f.w word, form, root, n, n_near, form_n from f join root using (w)""",
}
