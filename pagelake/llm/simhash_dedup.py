"""SimHash near-dedup: fingerprints, and links by a Gray-ordered hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import PIECE_BYTES, fresh, pieces, row_key, utf8, written
from pagelake.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BITS = 64
# Node pairs that one step of a search holds.
PAIRS = 1 << 20


def fingerprint(data: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Majority bits of the XXH64 of all word shingles of ``data`` (UTF-8), repeats included."""
    digest, counts, n, carry = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), 0, []
    for piece in pieces(data.lower(), PIECE_BYTES):  # bytes.lower() changes A-Z only
        words = carry + piece.split()
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())), np.uint64)
            for at in range(0, len(hashes), 1 << 16):
                block = hashes[at: at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
            n += len(hashes)
        carry = words[-(shingle - 1):] if shingle > 1 else []
    if not n and carry:
        return digest(b" ".join(carry), seed)
    bits = np.packbits(2 * counts > n)
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(k1, k2, doc, fp): a row per row of ``docs``; ``fp`` holds the 64 bits as a signed long."""
    k1, k2 = row_key(id_col, text_col)
    doc_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in utf8(batch.column(3))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp.view(np.int64))], ["k1", "k2", "doc", "fp"])

    return docs.select(k1.alias("k1"), k2.alias("k2"), F.col(id_col).alias("doc"), F.col(text_col).alias("text")).mapInArrow(
        run, f"k1 long, k2 long, doc {doc_type}, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence: codes next to each other in it differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def layouts(max_bits: int) -> list[tuple[list[int], int]]:
    """(order of blocks, bits in front) for each choice of blocks that agree.

    64 bits are cut into ``max_bits + 4`` blocks. Two codes that differ in at most ``max_bits`` bits
    agree in four blocks at least, so one of the choices brings them together. The rest, 22 bits with
    the default, bounds how many different codes can share a front.
    """
    n = max_bits + 4
    edges = [BITS * i // n for i in range(n + 1)]
    out = []
    for front in combinations(range(n), n - max_bits):
        order = [*front, *(i for i in range(n) if i not in front)]
        out.append(([b for i in order for b in range(edges[i], edges[i + 1])], sum(edges[i + 1] - edges[i] for i in front)))
    return out


def permute(codes: np.ndarray, order: list[int]) -> np.ndarray:
    """``codes`` with bit ``order[i]``, counted from the top, moved to place ``i``."""
    out, i = np.zeros_like(codes), 0
    while i < len(order):
        j = i
        while j + 1 < len(order) and order[j + 1] == order[j] + 1:
            j += 1
        width = j - i + 1
        mask = np.uint64((1 << width) - 1)
        out |= ((codes >> np.uint64(BITS - 1 - order[j])) & mask) << np.uint64(BITS - 1 - j)
        i = j + 1
    return out


def linked_pairs(codes: np.ndarray, front: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of the sorted, distinct ``codes`` that share their ``front`` bits and differ in few others.

    ``codes`` are in Gray order, in which codes with a common prefix are neighbours. A node of the
    index is a run of codes with one masked pattern; upper nodes factor the bits their members share, so
    a pair of nodes compares only the bits its level adds. A pair whose accumulated
    difference exceeds ``max_bits`` is pruned with all the codes below it.
    """
    rest = BITS - front
    cuts = [front, front + rest // 3, front + 2 * rest // 3, BITS]
    # Start of each node, by level.
    level_starts, patterns = [], []
    for cut in cuts:
        top = codes >> np.uint64(BITS - cut)
        new = np.ones(len(codes), bool)
        new[1:] = top[1:] != top[:-1]
        level_starts.append(np.flatnonzero(new))
        patterns.append(top[new])
    child = [np.searchsorted(level_starts[k + 1], np.append(level_starts[k], len(codes))) for k in range(3)]
    roots = np.flatnonzero(np.diff(np.append(level_starts[0], len(codes))) > 1)
    stack = []
    for at in range(0, len(roots), PAIRS):
        r = roots[at: at + PAIRS]
        stack.append((0, r, r, np.zeros(len(r), np.uint8)))
    while stack:
        level, a, b, far = stack.pop()
        if level == 3:
            i, j = level_starts[3][a], level_starts[3][b]
            yield i, j
            continue
        na, nb = child[level][a + 1] - child[level][a], child[level][b + 1] - child[level][b]
        total = na * nb
        if total.sum() > 4 * PAIRS and len(a) > 1:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half], far[:half]), (level, a[half:], b[half:], far[half:])]
            continue
        # All child pairs of each pair of nodes.
        which = np.repeat(np.arange(len(a)), total)
        k = np.arange(len(which)) - np.repeat(np.cumsum(total) - total, total)
        x = child[level][a][which] + k // nb[which]
        y = child[level][b][which] + k % nb[which]
        width = cuts[level + 1] - cuts[level]
        mask = np.uint64((1 << width) - 1)
        d = far[which] + np.bitwise_count((patterns[level + 1][x] ^ patterns[level + 1][y]) & mask).astype(np.uint8)
        keep = (d <= max_bits) & ((x < y) | ((x == y) & (level < 2)))
        for at in range(0, int(keep.sum()), PAIRS):
            w = np.flatnonzero(keep)[at: at + PAIRS]
            stack.append((level + 1, x[w], y[w], d[w]))


def find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = parent[up]


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least index of the group of each of ``n`` items under ``pairs``."""
    parent = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = find(parent, i), find(parent, j)
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    return find(parent, np.arange(n))


def links(codes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that join all codes of the distinct column ``fp`` within ``max_bits`` of each other.

    Each layout brings its front blocks to the top; (layout, front) is the partition key, and
    within a partition codes are sorted by Gray rank. One link per code and group
    leaves the task: to the group's first code, so linked groups stay joined without their pairs.
    """
    shapes = layouts(max_bits)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for k, (order, front) in enumerate(shapes):
                code = permute(fp, order)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(fp), k, np.int32)), pa.array((code >> np.uint64(BITS - front)).view(np.int64)),
                    pa.array((gray_rank(code) ^ np.uint64(1 << 63)).view(np.int64)), pa.array(code.view(np.int64)), batch.column(0)],
                    ["layout", "front", "rank", "code", "fp"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def flush(t: pa.Table) -> Iterator[pa.RecordBatch]:
            layout, code, fp = (t.column(c).to_numpy() for c in ("layout", "code", "fp"))
            cuts = np.flatnonzero(np.diff(layout)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(layout)]):
                root = spanning(hi - lo, linked_pairs(code[lo:hi].view(np.uint64), shapes[layout[lo]][1], max_bits))
                far = np.flatnonzero(root != np.arange(hi - lo))
                if len(far):
                    yield pa.RecordBatch.from_arrays([pa.array(fp[lo:hi][far]), pa.array(fp[lo:hi][root[far]])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            last = (t.column("layout")[-1].as_py(), t.column("front")[-1].as_py())
            held.append(t)
            rows += batch.num_rows
            if rows < 200_000:
                continue
            t = pa.concat_tables(held)
            own = (t.column("layout").to_numpy() == last[0]) & (t.column("front").to_numpy() == last[1])
            done = int(np.argmax(own))
            if done:  # groups that are complete
                yield from flush(t.slice(0, done))
                held, rows = [t.slice(done)], t.num_rows - done
        if held:
            yield from flush(pa.concat_tables(held))

    return (
        codes.select("fp").mapInArrow(spread, "layout int, front long, rank long, code long, fp long")
        .repartition("layout", "front").sortWithinPartitions("layout", "front", "rank")
        .mapInArrow(search, "a long, b long")
    )


def clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(k1, k2, doc, fp, component): ``component`` is the least id that links reach, itself included.

    Equal fingerprints are one node, whatever their number; nodes carry the least id, so copies are
    never paired. Null and empty texts have fingerprint zero and link like any other. A null id
    joins its group but does not name it unless all ids of the group are null.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = written(prints.groupBy("fp").agg(F.min("doc").alias("least")), "simhash-nodes")
    groups = connected_components(links(nodes, max_bits))
    named = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    of = written(named.drop("component").join(names, "root").select("fp", "component"), "simhash-groups")
    return prints.join(of, "fp")


def simhash_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group: the one with the least id, and of repeats of it the first by row key.

    Only row keys move until the groups are known; then texts meet the list of kept keys once. Exact
    repeats of a kept row (all columns) share its key, and one of them stays.
    """
    k1, k2, n = fresh(docs, "llm_k1", "llm_k2", "llm_n")
    # Ids order the rows of a group; a null id comes last.
    kept = clusters(docs, id_col, text_col, shingle, max_bits).groupBy("component").agg(
        F.min(F.struct(F.col("doc").isNull().alias("null"), "doc", "k1", "k2")).alias("m")
    ).select(F.col("m.k1").alias(k1), F.col("m.k2").alias(k2))
    a, b = row_key(id_col, text_col)
    once = docs.withColumns({k1: a, k2: b}).join(kept, [k1, k2], "left_semi")
    return once.dropDuplicates([k1, k2]).drop(k1, k2, n)
