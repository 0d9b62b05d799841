"""Plain versions of the operators, over small lists of (doc_id, text)."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np


def words(t):
    return (t or "").encode("utf-8", "surrogatepass").split()


def near(docs, size=3, percent=85):
    """{id: (set size, component)} by all pairs that share a shingle."""
    sets = {}
    for i, t in docs:
        w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in words(t)]
        n = min(size, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, s in sets.items():
        shared = Counter(j for x in s for j in held[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeats(docs, k):
    """{row number: covered words} of windows of k words that start twice."""
    w = [words(t) for _, t in docs]
    keys = [[tuple(x[i : i + k]) for i in range(len(x) - k + 1)] for x in w]
    seen = Counter(key for ks in keys for key in ks)
    out = []
    for x, ks in zip(w, keys, strict=True):
        cover = np.zeros(len(x), bool)
        for i, key in enumerate(ks):
            if seen[key] > 1:
                cover[i : i + k] = True
        out.append(cover)
    return w, out


def substring(docs, k=35):
    w, cover = repeats(docs, k)
    out = []
    for (i, _), x, c in zip(docs, w, cover, strict=True):
        kept = [a for a, z in zip(x, c, strict=True) if not z]
        out.append((i, len(x), len(x) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secrets(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, t) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    spans = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
    return tuple(sum(k == j for _, k, _ in found) for j in range(3)), hashlib.sha256(spans.encode()).hexdigest()


def nearest(rows, every, k, score, smallest):
    """{query: [(vec_id, score)]} by comparing all rows."""
    out = {}
    for q, a in rows:
        if q % every == 0:
            got = sorted(((score(a, b) if smallest else -score(a, b)), i) for i, b in rows if i != q)[:k]
            out[q] = [(i, s if smallest else -s) for s, i in got]
    return out
