"""Embedding near-dedup: sorted projection passes with bounded neighbour windows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelake.llm.common import fresh, written
from pagelake.llm.components import connected_components

COSINE = 0.9
# Share of the pairs at the threshold itself that the passes are to bring together.
RECALL = 0.97
WINDOW = 128
HASH_BITS = 63
TILE = 1024


def planes(passes: int, dims: int) -> np.ndarray:
    """Random directions of each pass: (dims, passes * bits)."""
    return np.random.default_rng(20_000 + dims).standard_normal((dims, passes * HASH_BITS))


def passes_for(n: int, cosine: float, window: int, recall: float = RECALL) -> int:
    """Passes that bring a pair at the threshold within ``window`` places with probability ``recall`` among ``n`` vectors.

    In one pass two vectors meet when the log2(n / window) first bits agree, each of which does with probability 1 - angle / pi.
    """
    meet = (1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi) ** max(0.0, math.log2(max(n, 1) / window))
    return 1 if meet >= recall else math.ceil(math.log(1 - recall) / math.log(1 - meet))


def matrix(values: pa.Array, kind: str) -> np.ndarray:
    """Unit rows in double precision of a binary column of floats of one length."""
    x = np.frombuffer(b"".join(values.to_pylist()), kind).astype("f8").reshape(len(values), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def float_kind(vectors: DataFrame, vector_col: str) -> str:
    """How a vector is packed: in the 32 bits it has, or in 64."""
    return "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, k1, k2, vec, dims): vectors that can link, as bytes; equal ones have equal keys."""
    v = F.col(vector_col).cast("array<double>")
    kind = float_kind(vectors, vector_col)
    norm = F.aggregate(v, F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    sound = F.size(v) > 0
    sound &= ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound &= norm > 0
    kept = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound).select(F.col(id_col).alias("vec_id"), v.alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            flat, off = lists.flatten().to_numpy(zero_copy_only=False) + 0.0, lists.offsets.to_numpy()
            off = off - off[0]
            vec = [flat[i:j].astype(kind).tobytes() for i, j in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off).astype(np.int32)), pa.array(vec, pa.binary())], ["vec_id", "dims", "vec"])

    id_type = kept.schema["vec_id"].dataType.simpleString()
    rows = kept.mapInArrow(packed, f"vec_id {id_type}, dims int, vec binary")
    return rows.select("vec_id", F.xxhash64(F.lit(1), "vec").alias("k1"), F.xxhash64(F.lit(2), "vec").alias("k2"), "dims", "vec")


def forest(x: np.ndarray, window: int, cosine: float, done: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(place, first place of its group): links of rows at most ``window`` places apart, as a star per group they form.

    Pairs among the first ``done`` rows are left out; they have been compared.
    """
    n = len(x)
    found = []
    for lo in range(0, n, window):
        hi = min(lo + window, n)
        i, j = np.nonzero(x[lo:hi] @ x[lo: hi + window].T >= cosine)
        i, j = i + lo, j + lo
        fits = (j > i) & (j - i <= window) & (j >= done)
        found.append(np.stack([i[fits], j[fits]]))
    i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), int)
    label = np.arange(n)
    while (label[i] != label[j]).any():
        low = np.minimum(label[i], label[j])
        for at in (label[i], label[j]):
            np.minimum.at(label, at, low)
        while (label != label[label]).any():
            label = label[label]
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def window_links(distinct: DataFrame, cosine: float, passes: int, window: int, kind: str) -> DataFrame:
    """(a, b): links that connect all ``rep`` linked within ``window`` places of each other in some pass, verified.

    Each pass sorts the vectors by their concatenated sign bits under its own random
    directions; passes are range-partitioned together, so no pass is one task. A batch of rows gives a
    star per group of linked rows, so a large group of near copies is as many links as rows. The first and last rows of each
    range meet those of its neighbours afterwards.
    """
    rep_type = distinct.schema["rep"].dataType.simpleString()
    columns = ["a", "b", "part", "place", "pass", "dims", "rep", "vec"]
    schema = f"a {rep_type}, b {rep_type}, part int, place long, pass int, dims int, rep {rep_type}, vec binary"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims):
                b = batch.filter(pa.array(dims == d))
                bits = (matrix(b.column(2), kind) @ planes(passes, int(d)) > 0).reshape(b.num_rows, passes, HASH_BITS)
                keys = bits.astype(np.int64) @ (np.int64(1) << np.arange(HASH_BITS - 1, -1, -1, dtype=np.int64))
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, p, np.int32)), b.column(1), pa.array(keys[:, p]), b.column(0), b.column(2)],
                                                     ["pass", "dims", "bits", "rep", "vec"])

    def linked(t: pa.Table, tail: dict) -> pa.Table:
        """Links of the next rows of a sorted stream; ``tail`` has the last rows before them."""
        group = np.stack([t.column(c).to_numpy() for c in t.column_names if c not in ("rep", "vec", "bits", "place")], axis=1)
        cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1), len(group)]
        pairs = []
        for lo, hi in zip(cuts, cuts[1:]):
            part, key = t.slice(lo, hi - lo), tuple(group[lo])
            x, rep, old = matrix(part.column("vec").combine_chunks(), kind), part.column("rep").combine_chunks(), 0
            if key in tail:
                old = len(tail[key][1])
                x, rep = np.concatenate([tail[key][0], x]), pa.concat_arrays([tail[key][1], rep])
            at, first = forest(x, window, cosine, old)
            pairs.append(pa.table({"a": rep.take(pa.array(first)), "b": rep.take(pa.array(at))}))
            tail.clear()
            tail[key] = (x[-window:], rep[-window:])
        return pa.concat_tables(pairs).combine_chunks()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: dict = {}
        head, last, rows = None, None, 0
        keep = ["pass", "dims", "rep", "vec"]

        def edge(t: pa.Table, place: int, negative: bool) -> Iterator[pa.RecordBatch]:
            n = t.num_rows
            at = np.arange(place, place + n, dtype=np.int64)
            none = pa.nulls(n, t.schema.field("rep").type)
            arrays = [none, none, pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)), pa.array(at - place - n if negative else at)]
            yield from pa.table([*arrays, *(t.column(c) for c in keep)], columns).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            pairs = linked(t, tail)
            n = pairs.num_rows
            if n:
                empty = [pa.nulls(n, f) for f in (pa.int32(), pa.int64(), pa.int32(), pa.int32(), t.schema.field("rep").type, pa.binary())]
                yield from pa.table([pairs.column("a"), pairs.column("b"), *empty], columns).combine_chunks().to_batches()
            t = t.select(keep)
            if rows < window:
                head = t.slice(0, window) if head is None else pa.concat_tables([head, t]).slice(0, window)
            last = t if last is None else pa.concat_tables([last, t])
            last = last.slice(max(0, last.num_rows - window)).combine_chunks()
            rows += batch.num_rows
        if rows:
            yield from edge(head, 0, False)  # places from 0 meet the range before, those below 0 the one behind
            yield from edge(last, 0, True)

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: dict = {}
        for batch in batches:
            if batch.num_rows:
                yield from linked(pa.Table.from_batches([batch]), tail).to_batches()

    found = written(
        distinct.select("rep", "dims", "vec").mapInArrow(spread, f"pass int, dims int, bits long, rep {rep_type}, vec binary")
        .repartitionByRange("pass", "dims", "bits", "rep").sortWithinPartitions("pass", "dims", "bits", "rep")
        .mapInArrow(compare, schema), "vector-links")
    edges = found.filter("part IS NOT NULL")
    # A range without rows is no neighbour; there are as many rows here as ranges.
    order = edges.select("part").distinct().select("part", F.row_number().over(Window.orderBy("part")).alias("nth"))
    met = edges.join(order, "part").select((F.col("nth") + (F.col("place") < 0).cast("int")).alias("border"), "pass", "dims", "place", "rep", "vec")
    across = met.repartition("border").sortWithinPartitions("border", "pass", "dims", "place").mapInArrow(border, f"a {rep_type}, b {rep_type}")
    return found.filter("a IS NOT NULL").select("a", "b").unionByName(across)


def link_counts(members: DataFrame, cosine: float, kind: str) -> DataFrame:
    """(rep, n_links) for ``members`` (component, rep, size, vec): all links within a component, counted.

    Windows connect a large group but don't show all its links. Vectors within half the linking angle
    of the component's first one all link with each other, so they are only summed. The
    others are compared with the whole component in tiles, and only counts leave a tile.
    """
    half = math.cos(math.acos(cosine) / 2) + 1e-12
    rep_type = members.schema["rep"].dataType.simpleString()
    lead = members.filter("rep = component").select(F.col("component").alias("c"), F.col("vec").alias("lead"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                core = np.array([float((matrix(pa.array([x], pa.binary()), kind) @ matrix(pa.array([y], pa.binary()), kind).T)[0, 0]) >= half
                                 for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist())])
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(core)], ["component", "rep", "size", "vec", "core"])

    placed = written(members.join(lead, F.col("component") == F.col("c")).select("component", "rep", "size", "vec", "lead").mapInArrow(
        near, f"component {rep_type}, rep {rep_type}, size long, vec binary, core boolean"), "vectors-placed")
    sums = placed.groupBy("component").agg(
        F.sum(F.when(F.col("core"), F.col("size"))).alias("core_size"), F.count("*").alias("n"), F.sum((~F.col("core")).cast("long")).alias("n_shell"))
    sums = written(sums.select("component", "core_size", F.expr(f"cast(ceil(n / {TILE}) as int)").alias("tiles"), F.expr(f"cast(ceil(n_shell / {TILE}) as int)").alias("shells")), "vectors-sums")
    with_tiles = placed.join(sums.filter("shells > 0"), "component")
    # Rows compare only within the tile (component, s, m): shell rows of part s with rows of part m.
    own = F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    shell = with_tiles.filter("NOT core").withColumn("s", F.pmod(F.xxhash64(F.lit(1), "rep"), F.col("shells")).cast("int")).select(
        "component", "s", F.explode(F.expr("sequence(0, tiles - 1)")).alias("m"), F.lit(True).alias("asks"), "core", "rep", "size", "vec")
    other = with_tiles.withColumn("m", own).select(
        "component", F.explode(F.expr("sequence(0, shells - 1)")).alias("s"), "m", F.lit(False).alias("asks"), "core", "rep", "size", "vec")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            asks = t.column("asks").to_numpy(zero_copy_only=False)
            rep, size, core = t.column("rep").to_numpy(), t.column("size").to_numpy(), t.column("core").to_numpy(zero_copy_only=False)
            if not asks.any() or asks.all():
                return rep[:0], size[:0]
            x = matrix(t.column("vec").combine_chunks(), kind)
            linked = (x[asks] @ x[~asks].T >= cosine) & (rep[asks][:, None] != rep[~asks][None, :])
            inner = core[~asks]
            return (np.concatenate([rep[asks], rep[~asks][inner]]),
                    np.concatenate([linked @ size[~asks], (size[asks] @ linked)[inner]]))

        held: list[pa.Table] = []
        last = None

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                t = pa.concat_tables(held)
                key = np.stack([t.column(c).to_numpy() for c in ("component", "s", "m")], axis=1)
                cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(key)]
                parts = [done(t.slice(lo, hi - lo)) for lo, hi in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[0] for p in parts])), pa.array(np.concatenate([p[1] for p in parts]).astype(np.int64))], ["rep", "more"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            key = np.stack([t.column(c).to_numpy() for c in ("component", "s", "m")], axis=1)
            final = (key == key[-1]).all(axis=1)
            lead_rows = 0 if final.all() else len(final) - int(np.argmin(final[::-1]))
            if lead_rows or (last is not None and last != tuple(key[0])):
                held.append(t.slice(0, lead_rows))
                yield from out()
                held = []
            held.append(t.slice(lead_rows))
            last = tuple(key[-1])
        yield from out()

    more = (
        shell.unionByName(other).repartition("component", "s", "m").sortWithinPartitions("component", "s", "m")
        .mapInArrow(tiles, f"rep {rep_type}, more long").groupBy("rep").agg(F.sum("more").alias("more"))
    )
    return (
        placed.join(sums, "component").join(more, "rep", "left")
        .select("rep", (F.when(F.col("core"), F.col("core_size")).otherwise(F.col("size")) - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    )


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                    passes: int | None = None, window: int = WINDOW) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Equal vectors are one class, kept by the least id and never paired. Passes find links between classes;
    groups are their components, and links within a group are then counted in full. Vectors that
    are null, empty, zero or not finite, and rows without id, link with nothing. Vectors
    of different lengths don't link. Of rows with one id, whose vectors may differ, each has the id's
    most links and least group; other columns are not read; an empty table gives an empty result.

    Without ``passes`` there are as many as ``passes_for`` the number of distinct vectors, so a pair at the threshold is as
    likely to be found in a large table as in a small one. With a ``window`` of all vectors one pass compares every pair.
    """
    kind = float_kind(vectors, vector_col)
    rows = written(classes(vectors, id_col, vector_col), "vectors")
    distinct = written(rows.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("dims").alias("dims"), F.first("vec").alias("vec")), "vector-classes")
    passes = passes or passes_for(distinct.count(), cosine, window)
    groups = connected_components(window_links(distinct, cosine, passes, window, kind))
    members = written(distinct.join(groups.withColumnRenamed("node", "rep"), "rep").select("component", "rep", "size", "vec"), "vector-groups")
    counts = link_counts(members, cosine, kind)
    of = (
        distinct.select("k1", "k2", "rep", "size").join(members.select("rep", "component"), "rep", "left").join(counts, "rep", "left")
        .select("k1", "k2", F.coalesce("component", "rep").alias("component_id"), F.coalesce("n_links", F.col("size") - 1).alias("n_links"))
    )
    linked = rows.select("vec_id", "k1", "k2").join(of, ["k1", "k2"]).select(F.col("vec_id").alias("v"), "component_id", "n_links").groupBy("v").agg(
        F.min("component_id").alias("component_id"), F.max("n_links").alias("n_links"))
    (v,) = fresh(vectors, "llm_v")
    return vectors.select(id_col).join(linked.withColumnRenamed("v", v), F.col(id_col) == F.col(v), "left").select(
        F.col(id_col).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", F.col(id_col)).alias("component_id"),
        F.coalesce(F.col(id_col) == F.coalesce("component_id", F.col(id_col)), F.lit(True)).alias("kept"))
