"""Substring dedup: repeated windows of words by super-k-mer partitioning.

A window is ``k`` consecutive words. Its minimiser is the least hash of its ``m``-word parts, so
neighbouring windows mostly share it, and the words under such a row of windows, a
super-k-mer, go as one packed string to the bucket of that minimiser. Equal windows have equal
minimisers, so every bucket counts its own windows by sorting them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import PIECE_BYTES, fresh, pieces, row_key, utf8

WINDOW_WORDS = 35
MINIMISER_WORDS = 8
BUCKETS_PER_PARTITION = 4
# A bucket's repeats are first folded when it holds this much text.
HELD_BYTES = 24 << 20
_STEP = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser, so that the order of hashes says nothing about words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def _rolled(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive entries of ``h``: doubled spans, then the bits of ``size`` joined."""
    out, done, span, width = None, 0, h, 1
    power = _STEP
    while True:
        if size & width:
            if out is None:
                out, done = span, width
            else:
                n = len(h) - done - width + 1
                out = out[:n] + span[done: done + n] * np.uint64(pow(_STEP, done, 1 << 64))
                done += width
        if done == size:
            return _mixed(out[: len(h) - size + 1])
        n = len(h) - 2 * width + 1
        span = span[:n] + span[width: width + n] * np.uint64(power)
        width *= 2
        power = power * power % (1 << 64)


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (size - width)], x[size - width:]) if size > width else x


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def repeated(window: np.ndarray, starts: np.ndarray, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(repeat, first) for windows with hashes ``window`` that start at ``starts`` in ``h``.

    Sorted by hash, equal neighbours are compared word by word, so a hash alone never
    makes a repeat. Of equal windows the one that starts first is ``first``.
    """
    order = np.argsort(window, kind="stable")
    w = window[order]
    equal = np.flatnonzero(w[1:] == w[:-1])
    same = np.zeros(len(w), bool)  # same[i]: i equals i - 1
    for at in range(0, len(equal), 1 << 16):
        e = equal[at: at + (1 << 16)]
        a, b, ok = starts[order[e]], starts[order[e + 1]], np.ones(len(e), bool)
        for j in range(k):
            ok &= h[a + j] == h[b + j]
        same[e[ok] + 1] = True
    twice = same.copy()
    twice[:-1] |= same[1:]
    repeat, first = np.zeros(len(w), bool), np.ones(len(w), bool)
    repeat[order], first[order] = twice, ~same
    return repeat, first


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


SPLIT = "bucket int, k1 long, k2 long, spans binary, minimisers binary, keys binary, places binary, texts binary"


def _split(k: int, m: int, buckets: int):
    """Texts to packed super-k-mers, one row per bucket and about 4 MB of text, and to spans known already.

    Windows that this much text holds twice are settled here. Of equal windows only the first goes
    on to its bucket, so a passage of many documents reaches it once per 4 MB.
    """
    def work(group: list[tuple[int, int, int, list[bytes]]], packer) -> Iterator[tuple]:
        # group: row key, number of the first word, words
        words = [w for *_, ws in group for w in ws]
        sizes = np.fromiter((len(g[3]) for g in group), np.int64, len(group))
        offset = np.cumsum(sizes) - sizes
        h = _word_hashes(words)
        if len(h) < k:
            return
        grams, window = _rolled(h, m), _rolled(h, k)
        least = _sliding_min(grams, k - m + 1)
        # Windows must not cross rows.
        row = np.repeat(np.arange(len(group)), np.maximum(sizes - k + 1, 0))
        starts = np.concatenate([np.arange(o, o + max(s - k + 1, 0)) for o, s in zip(offset.tolist(), sizes.tolist())] or [[]]).astype(np.int64)
        if not len(starts):
            return
        window, least = window[starts], least[starts]
        repeat, first = repeated(window, starts, h, k)
        for i, (lo, hi) in enumerate(zip(np.searchsorted(row, np.arange(len(group))), np.searchsorted(row, np.arange(len(group)), "right"))):
            if hi > lo and repeat[lo:hi].any():
                a, b = _spans(repeat[lo:hi])
                key = group[i]
                spans = np.stack([a + key[2], b + key[2] + k - 1]).astype("<i8")
                yield int(key[0] % buckets), key[0], key[1], spans.T.tobytes(), None, None, None, None
        new = np.ones(len(starts), bool)
        new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(starts))
        wanted = np.add.reduceat(first, begin) > 0
        begin, end = begin[wanted], end[wanted]
        minimiser = least[begin]
        bucket = (minimiser % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, cuts):
            s, e, r = starts[begin[part]], starts[end[part] - 1] + k, row[begin[part]]
            text = b"\n".join([b" ".join(words[a:b]) for a, b in zip(s.tolist(), e.tolist())])
            keys = np.array([[group[i][0], group[i][1]] for i in r.tolist()], "<i8")
            places = (s - offset[r] + np.array([group[i][2] for i in r.tolist()])).astype("<i8")
            yield int(bucket[part[0]]), None, None, None, minimiser[part].astype("<u8").tobytes(), keys.tobytes(), places.tobytes(), packer.compress(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        names = [f.split()[0] for f in SPLIT.split(", ")]
        types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]

        def out(group) -> Iterator[pa.RecordBatch]:
            rows = list(work(group, packer))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        group, size = [], 0
        for batch in batches:
            for k1, k2, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
                at, tail = 0, []
                for piece in pieces(text):
                    words = tail + piece.split()
                    if size and size + len(piece) > PIECE_BYTES:
                        yield from out(group)
                        group, size = [], 0
                    if len(words) >= k:
                        group.append((k1, k2, at, words))
                        size += len(piece)
                    at += max(len(words) - k + 1, 0)
                    tail = words[-(k - 1):]
        if group:
            yield from out(group)

    return run


class _Bucket:
    """Super-k-mers of one bucket: minimiser, row key, number of the first word, words."""

    def __init__(self, k: int):
        self.k, self.rows, self.size = k, [], 0

    def add(self, minimisers: bytes, keys: bytes, places: bytes, texts: bytes) -> None:
        texts = texts.split(b"\n")
        self.rows.append((np.frombuffer(minimisers, "<u8"), np.frombuffer(keys, "<i8").reshape(-1, 2), np.frombuffer(places, "<i8"), texts))
        self.size += sum(map(len, texts))

    def count(self, again: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """(row keys, spans) of the windows held twice so far. ``again``: of equal windows only one is kept on."""
        if not self.rows:
            return None
        k = self.k
        minimiser, keys, places = (np.concatenate([r[i] for r in self.rows]) for i in range(3))
        texts = [t for r in self.rows for t in r[3]]
        _, where, many = np.unique(minimiser, return_inverse=True, return_counts=True)
        shared = many[where] > 1
        if not shared.any():
            return None
        alone, at = ~shared, np.flatnonzero(shared)
        words = [texts[i].split() for i in at.tolist()]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        h = _word_hashes([w for ws in words for w in ws])
        offset = np.cumsum(sizes) - sizes
        n = sizes - k + 1
        part = np.repeat(np.arange(len(words)), n)
        within = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
        starts = offset[part] + within
        repeat, first = repeated(_rolled(h, k)[starts], starts, h, k)
        if again:
            alone[at[np.unique(part[first])]] = True
            keep = np.flatnonzero(alone)
            self.rows = [(minimiser[keep], keys[keep], places[keep], [texts[i] for i in keep.tolist()])]
            self.size = sum(map(len, self.rows[0][3]))
        joined = repeat[1:] & repeat[:-1] & (part[1:] == part[:-1])
        lead, trail = np.flatnonzero(repeat & ~np.append(False, joined)), np.flatnonzero(repeat & ~np.append(joined, False))
        spans = np.stack([places[at][part[lead]] + within[lead], places[at][part[trail]] + within[trail] + k], axis=1)
        return keys[at][part[lead]], spans.astype("<i8")


def _counted(k: int):
    """Rows sorted by bucket to the spans of words whose windows a bucket holds twice; settled spans pass through.

    A bucket is taken in as it comes. Whenever what is held has doubled, its repeats are reported and
    one of each window is kept on, so a passage that very many documents share is held once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, own, current, limit = zstandard.ZstdDecompressor(), None, None, HELD_BYTES

        def out(found) -> Iterator[pa.RecordBatch]:
            if found is not None and len(found[0]):
                keys, spans = found
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([x.tobytes() for x in spans], pa.binary())], ["k1", "k2", "spans"])

        for batch in batches:
            settled = batch.filter(pc.is_valid(batch.column("spans"))).select(["k1", "k2", "spans"])
            if settled.num_rows:
                yield settled
            packed = batch.filter(pc.is_valid(batch.column("texts")))
            for bucket, *row, blob in zip(*(packed.column(c).to_pylist() for c in ("bucket", "minimisers", "keys", "places", "texts"))):
                if bucket != current:
                    if own is not None:
                        yield from out(own.count(False))
                    own, current, limit = _Bucket(k), bucket, HELD_BYTES
                own.add(*row, unpack.decompress(blob))
                if own.size > limit:
                    yield from out(own.count(True))
                    limit = max(HELD_BYTES, 2 * own.size)
        if own is not None:
            yield from out(own.count(False))

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS,
                   minimiser: int = MINIMISER_WORDS, buckets: int | None = None) -> DataFrame:
    """(k1, k2, spans): word spans of repeated windows by row key, as pairs of little-endian 64-bit start, end.

    ``buckets`` defaults to four per shuffle partition, so what a bucket holds, its different
    windows, shrinks as partitions are added.
    """
    k1, k2 = row_key(id_col, text_col)
    buckets = buckets or BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text")).mapInArrow(_split(window, minimiser, buckets), SPLIT)
    spans = split.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_counted(window), "k1 long, k2 long, spans binary")
    return spans.groupBy("k1", "k2").agg(F.collect_list("spans").alias("spans"))


def covered(spans: list[bytes] | None) -> np.ndarray:
    """Disjoint (start, end) rows in order."""
    if spans is None or not len(spans):
        return np.empty((0, 2), np.int64)
    x = np.frombuffer(b"".join(spans), "<i8").reshape(-1, 2)
    x = x[np.argsort(x[:, 0], kind="stable")]
    top = np.maximum.accumulate(x[:, 1])
    new = np.ones(len(x), bool)
    new[1:] = x[1:, 0] > top[:-1]
    first = np.flatnonzero(new)
    return np.stack([x[first, 0], top[np.append(first[1:], len(x)) - 1]], axis=1)


def kept_words(text: bytes, spans: np.ndarray) -> Iterator[tuple[list[bytes], int, int]]:
    """(words kept, words, words removed) for each piece of ``text``."""
    at = 0
    for piece in pieces(text):
        words = piece.split()
        if len(spans):
            lo, hi = np.clip(spans[:, 0] - at, 0, len(words)), np.clip(spans[:, 1] - at, 0, len(words))
            kept, last = [], 0
            for a, b in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                kept += words[last:a]
                last = b
            kept += words[last:]
        else:
            kept = words
        yield kept, len(words), len(words) - len(kept)
        at += len(words)


_DIGEST = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])


@F.pandas_udf(_DIGEST)
def _digest(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for t, s in zip(text, spans):
        sha, n, gone, blank = hashlib.sha256(), 0, 0, b""
        for kept, words, removed in kept_words((t or "").encode(), covered(s)):
            if kept:
                sha.update(blank + b" ".join(kept))
                blank = b" "
            n, gone = n + words, gone + removed
        rows.append((n, gone, sha.hexdigest()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])


@F.pandas_udf(T.StringType())
def _kept_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([b" ".join(w for kept, *_ in kept_words((t or "").encode(), covered(s)) for w in kept).decode() for t, s in zip(text, spans)], dtype=object)


def _with_spans(docs: DataFrame, id_col: str, text_col: str, how: dict) -> tuple[DataFrame, str, list[str]]:
    k1, k2, spans = fresh(docs, "llm_k1", "llm_k2", "llm_spans")
    found = repeated_spans(docs, id_col, text_col, **how).select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(spans))
    a, b = row_key(id_col, text_col)
    return docs.withColumns({k1: a, k2: b}).join(found, [k1, k2], "left"), spans, [k1, k2]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the words of repeated windows gone from ``text``, the rest joined by one blank.

    Null texts become empty; repeated rows repeat each other's windows; other columns stay.
    """
    joined, spans, keys = _with_spans(docs, id_col, text_col, how)
    return joined.withColumn(text_col, _kept_text(text_col, spans)).drop(spans, *keys)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    joined, spans, _ = _with_spans(docs.select(id_col, text_col), id_col, text_col, how)
    return joined.select(F.col(id_col).alias("doc_id"), _digest(text_col, spans).alias("d")).select("doc_id", "d.*")
