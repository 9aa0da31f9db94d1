"""Plain restatements of the contracts, for comparison on small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import xxhash

sha = lambda b: hashlib.sha256(b).hexdigest()
SPACE = " \t\n\x0b\f\r"


def words(text) -> list[bytes]:
    return (text or "").encode().split()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def substring(rows, k=35):
    """rows: (doc_id, text). A list of (doc_id, n_words, n_removed, sha)."""
    count = Counter(tuple(w[i: i + k]) for w in (words(t) for _, t in rows) for i in range(len(w) - k + 1))
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - k + 1):
            if count[tuple(w[i: i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((d, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def lines(rows, min_chars=40, min_docs=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(SPACE).translate(lower)
    docs = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            docs[key(x)].add(d)
    out = []
    for d, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if len(key(x)) < min_chars or len(docs[key(x)]) < min_docs or max(docs[key(x)], key=lambda v: (v is not None, v or 0)) == d]
        out.append((d, len(ls), len(ls) - len(kept), sha("\n".join(kept).encode())))
    return out


def simhash(text):
    w = [x.lower() for x in words(text)]
    parts = [b" ".join(w[i: i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_groups(rows):
    fps = {d: simhash(t) for d, t in rows}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 2]
    comp = components(ids, links)
    return [(d, f"{fps[d]:016x}", comp[d]) for d in ids]


def quality(text):
    w = [x.decode() for x in words(text)]
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if x.strip(SPACE):
            dup += x in seen
            seen.add(x)
    c = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
    cov = {j for i in range(len(w) - 2) if c[tuple(w[i: i + 3])] > 1 for j in range(i, i + 3)}
    failed = len(w) < 50 or 100 * len(cov) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(s) for s in "#*$%&|<>"), dup, len(cov), failed)
