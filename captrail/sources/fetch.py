"""Byte ranges of archives fetched in tasks. The backend is a function, so tests need no network."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from captrail.functions.urls import TRANSIENT_PATTERN
from captrail.operators import slices, warc
from captrail.paths import store
from captrail.session import ship

TRANSIENT = re.compile(TRANSIENT_PATTERN)

Fetch = Callable[[str, int, int], bytes]


def file_range(root: str) -> Fetch:
    """A backend over a folder that all tasks can read; a short read is an error."""

    def fetch(name: str, start: int, end: int) -> bytes:
        with open(f"{root}/{name}", "rb") as f:
            f.seek(start)
            got = f.read(end - start + 1)
        if len(got) < end - start + 1:
            raise OSError("short read")
        return got

    return fetch


def store_range(root: str) -> Fetch:
    """A backend over a folder of any store that pyarrow knows (local, HDFS, S3 ...); a short read is an error."""

    def fetch(name: str, start: int, end: int) -> bytes:
        fs, base = store(root)
        with fs.open_input_file(f"{base}/{name}") as f:
            got = f.read_at(end - start + 1, start)
        if len(got) < end - start + 1:
            raise OSError("short read")
        return got

    return fetch


def store_size(root: str) -> Callable[[str], int | None]:
    """The size of a file of that folder, null if there is none."""

    def size(name: str) -> int | None:
        fs, base = store(root)
        return fs.get_file_info(f"{base}/{name}").size

    return size


def whole_files(root: str, folder: str, most: int = 5_000_000_000) -> Fetch:
    """A backend over whole files: the first range of a file copies all of it to folder, under a name that its own name
    determines, and ranges are read there. Files over `most` bytes are an error before anything is copied. A copy takes its name when it
    is whole, so tasks that copy the same file at once do no harm."""
    import hashlib
    import uuid

    local = store_range(folder)

    def fetch(name: str, start: int, end: int) -> bytes:
        from_fs, base = store(root)
        to_fs, target = store(folder)
        kept = f"{hashlib.sha256(name.encode()).hexdigest()[:16]}__{name.rsplit('/', 1)[-1]}"
        info = from_fs.get_file_info(f"{base}/{name}")
        if info.size is None or info.size > most:
            raise ValueError(f"size {info.size} is over {most} or unknown")
        if to_fs.get_file_info(f"{target}/{kept}").size != info.size:
            to_fs.create_dir(target)
            part = f"{target}/.{uuid.uuid4().hex}"
            with from_fs.open_input_stream(f"{base}/{name}", compression=None) as a, to_fs.open_output_stream(part, compression=None) as b:
                while block := a.read(1 << 22):
                    b.write(block)
            to_fs.move(part, f"{target}/{kept}")
        return local(kept, start, end)

    return fetch


def http_range(prefix: str, timeout: float = 30.0) -> Fetch:
    """A backend over HTTP that accepts partial content only."""

    def fetch(name: str, start: int, end: int) -> bytes:
        import urllib.request

        url = name if name.startswith(("http://", "https://")) else prefix.rstrip("/") + "/" + name.lstrip("/")
        with urllib.request.urlopen(urllib.request.Request(url, headers={"Range": f"bytes={start}-{end}"}), timeout=timeout) as r:
            if r.status != 206:
                raise OSError(f"status {r.status}")
            return r.read()

    return fetch


def transient(error: str) -> bool:
    """Whether an error text is worth another try."""
    return TRANSIENT.search(error.lower()) is not None


def patient(fetch: Fetch, tries: int = 3, wait: float = 0.5, rate_limited: float = 2.0) -> Fetch:
    """fetch with further tries after transient errors, after waits that double and vary by a quarter; two seconds at least
    when asked to slow down. Other errors are final at once."""

    def again(name: str, start: int, end: int) -> bytes:
        for k in range(tries):
            try:
                return fetch(name, start, end)
            except Exception as e:  # noqa: BLE001  the last one is raised
                if k == tries - 1 or not transient(f" {e}"):
                    raise
                pause = wait * 2**k * random.uniform(0.75, 1.25)
                time.sleep(max(rate_limited, pause) if "429" in str(e) else pause)
        raise AssertionError

    return again


def sized(fetch: Fetch, size: Callable[[str], int | None], most: int = 5_000_000_000) -> Fetch:
    """fetch behind a look at the whole file's size (an HTTP HEAD, a file status): files larger than most, or of unknown
    size, are an error, and ranges beyond the end are none of the file's."""

    def guarded(name: str, start: int, end: int) -> bytes:
        n = size(name)
        if n is None or n > most:
            raise ValueError(f"size {n} is over {most} or unknown")
        if end >= n:
            raise ValueError(f"range ends at {end}, the file at {n}")
        return fetch(name, start, end)

    return guarded


def http_size(prefix: str, timeout: float = 30.0) -> Callable[[str], int | None]:
    """The Content-Length that a HEAD request gives."""

    def size(name: str) -> int | None:
        import urllib.request

        url = name if name.startswith(("http://", "https://")) else prefix.rstrip("/") + "/" + name.lstrip("/")
        with urllib.request.urlopen(urllib.request.Request(url, method="HEAD"), timeout=timeout) as r:
            n = r.headers.get("Content-Length")
            return int(n) if n else None

    return size


def by_strategy(mode: str, ranged: Fetch, full: Fetch | None = None) -> Fetch:
    """'range': ranges only; 'full': out of whole files (kept by the backend `full`) only; 'auto': out of whole files, and by
    range where that fails."""
    if mode not in ("range", "auto", "full"):
        raise ValueError(f"no strategy {mode}")
    if mode != "range" and full is None:
        raise ValueError("whole files need a backend")

    def fetch(name: str, start: int, end: int) -> bytes:
        if mode != "range":
            try:
                return full(name, start, end)
            except Exception:  # noqa: BLE001
                if mode == "full":
                    raise
        return ranged(name, start, end)

    return fetch


MEMBERS = pa.schema([("w", pa.string()), ("o", pa.int64()), ("l", pa.int64()), ("bytes", pa.binary()), ("how", pa.string()), ("error", pa.string())])


def fetch_members(spans: DataFrame, fetch: Fetch, tasks: int, max_gap: int = 256_000, max_slice: int = 25_000_000, key: str = "w", offset: str = "o", length: str = "l", check: bool = True) -> DataFrame:
    """(key, o, l, bytes, how, error) of distinct valid ranges: fetched by slices, cut out of them and checked; members of a
    slice that failed, was short or held no record there are fetched once more, each by itself.

    how: 'slice', 'range' (second try) or 'failed' with the error. A task fetches a slice, cuts it and makes the second tries
    in one pass; it holds one slice and a batch. The members are written once, so that nothing is fetched twice, and read again."""
    from captrail.paths import written

    ship(spans.sparkSession)
    plan = slices.slice_plan(spans, max_gap, max_slice, 0, key, offset, length)
    dealt = balanced(plan.select(key, "slice_start", "slice_end", "members"), tasks, key).repartitionById(tasks, "task").drop("task")
    names = [key, *MEMBERS.names[1:]]

    def tried(name: str, start: int, end: int) -> tuple[bytes | None, str | None]:
        try:
            return fetch(name, start, end), None
        except Exception as e:  # noqa: BLE001  a failure is a row
            return None, f"{type(e).__name__}: {e}"

    def fault(got: bytes | None) -> str | None:
        return warc.blob_fault(got) if check else None if got is not None else "empty"

    def of_slice(name: str, start: int, end: int, members: list[dict]) -> Iterator[tuple]:
        blob, _ = tried(name, start, end)
        for m in members:
            o, n = m["o"], m["l"]
            part = blob[o - start : o - start + n] if blob is not None and o - start + n <= len(blob) else None
            if fault(part) is None:
                yield name, o, n, part, "slice", None
                continue
            part, error = tried(name, o, o + n - 1)
            wrong = fault(part)
            yield name, o, n, None if wrong else part, "failed" if wrong else "range", (error or wrong) if wrong else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), MEMBERS.types, strict=True)], names=names)
        for b in batches:
            for one in zip(*[b.column(c).to_pylist() for c in (key, "slice_start", "slice_end", "members")], strict=True):
                for row in of_slice(*one):
                    rows.append(row)
                    size += len(row[3] or b"")
                    if size > 1 << 24 or len(rows) == 4096:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()

    return written(dealt.mapInArrow(run, f"`{key}` string, o long, l long, bytes binary, how string, error string"), "members")


def fetch_counts(members: DataFrame, key: str = "w") -> DataFrame:
    """Per archive: members fetched and failed, those of a second try, bytes."""
    n = lambda cond: F.count(F.when(cond, 1))
    return members.groupBy(key).agg(n(F.col("how") != "failed").alias("n_ok"), n(F.col("how") == "failed").alias("n_failed"), n(F.col("how") == "range").alias("n_second"), F.coalesce(F.sum(F.length("bytes")), F.lit(0)).cast("long").alias("n_bytes"))


def balanced(plan: DataFrame, tasks: int, key: str = "w") -> DataFrame:
    """plan with task: slices in a hashed order, which spreads the slices of an archive over tasks, are cut into stretches of about
    equal bytes. A task is over the mean by its last slice at most.

    Running bytes are sums in two levels: of the parts of the order, then within a part; no task sees all slices."""
    # The order is that of an MD5; its first digits name the part.
    p = plan.withColumn("_at", F.md5(F.concat_ws(":", key, "slice_start"))).withColumn("_part", F.substring("_at", 1, 3))
    p = p.withColumn("_bytes", F.col("slice_end") - F.col("slice_start") + 1)
    sums = p.groupBy("_part").agg(F.sum("_bytes").alias("_sum"))
    order = Window.orderBy("_part")  # 4,096 rows at most
    sums = sums.select("_part", F.coalesce(F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    w = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("_within", F.coalesce(F.sum("_bytes").over(w), F.lit(0))).join(sums, "_part")
    # The middle of a slice decides: so a slice goes where most of it falls.
    task = F.expr(f"cast(least({tasks - 1}, ((2 * (_before + _within) + _bytes) * {tasks}) div (2 * _all)) as int)")
    return p.withColumn("task", task).drop("_part", "_before", "_within", "_at", "_bytes", "_all")


def fetch_slices(plan: DataFrame, fetch: Fetch, tasks: int, key: str = "w") -> DataFrame:
    """(key, slice_start, slice_end, blob, error) of a slice plan, slices dealt to tasks by their bytes. Failures are rows."""
    ship(plan.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        for b in batches:
            rows, size = [], 0
            for name, start, end in zip(*[b.column(c).to_pylist() for c in (key, "slice_start", "slice_end")], strict=True):
                try:
                    blob, error = fetch(name, start, end), None
                except Exception as e:  # noqa: BLE001
                    blob, error = None, f"{type(e).__name__}: {e}"
                rows.append((name, start, end, blob, error))
                size += len(blob or b"")
                if size > 1 << 24 or len(rows) == 512:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[key, "slice_start", "slice_end", "blob", "error"])
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[key, "slice_start", "slice_end", "blob", "error"])

    dealt = balanced(plan.select(key, "slice_start", "slice_end"), tasks, key).repartitionById(tasks, "task").drop("task")
    return dealt.mapInArrow(run, f"`{key}` string, slice_start long, slice_end long, blob binary, error string")
