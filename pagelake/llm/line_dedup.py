"""Line dedup: range-partitioned line hashes, first occurrences streamed, keep bitmaps out."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import ASCII_SPACE, fresh, row_key, written

MIN_KEY_CHARS = 40
MIN_DOCS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_array(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_table(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: row key, id, position, 128-bit key hash."""
    k1, k2 = row_key(id_col, text_col)
    lines = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(id_col).alias("doc"), line_array(text_col).alias("lines"))
    keys = (
        lines.select("k1", "k2", "doc", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
        .filter(F.length("line") >= min_chars)
        .withColumn("key", F.translate(F.trim("line", F.lit(ASCII_SPACE)), UPPER, LOWER))
        .filter(F.length("key") >= min_chars)
    )
    return keys.select("k1", "k2", "doc", "n_lines", "pos", F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))


def _runs(min_docs: int):
    """Over sorted lines: decide each run of a hash that lies within the partition; mark the others.

    A run at either end of a partition may go on in the next one, so its rows
    leave undecided (``edge``). At most one run of the partition is held.
    """
    out = ["k1", "k2", "n_lines", "pos", "h1", "h2", "doc", "edge", "first"]

    def marked(t: pa.Table, edge: np.ndarray | bool) -> pa.RecordBatch | None:
        n = t.num_rows
        h1, h2 = (t.column(c).to_numpy() for c in ("h1", "h2"))
        doc = t.column("doc").fill_null(0).to_numpy()
        null = t.column("doc").is_null().to_numpy()
        new_run = np.ones(n, bool)
        new_run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first = new_run.copy()
        first[1:] |= (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])
        run = np.cumsum(new_run) - 1
        docs = np.bincount(run, weights=first, minlength=run[-1] + 1)
        ordinal = np.cumsum(first)
        is_top = ordinal == ordinal[new_run][run]
        edge = np.full(n, edge) if isinstance(edge, bool) else edge
        keep = edge | ((docs[run] >= min_docs) & ~is_top)
        if not keep.any():
            return None
        t = t.append_column("edge", pa.array(edge)).append_column("first", pa.array(first))
        return t.filter(pa.array(keep)).select(out).combine_chunks().to_batches()[0]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held, at_head, last_doc = None, [], True, None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            h1, h2 = t.column("h1").to_numpy(), t.column("h2").to_numpy()
            head = head or (h1[0], h2[0])
            if at_head:  # rows of the first run leave at once
                n = int(np.argmin((h1 == head[0]) & (h2 == head[1]))) if (h1[-1], h2[-1]) != head else len(h1)
                b = marked(t.slice(0, n), True) if n else None
                if b is not None:
                    d = t.column("doc")[0].as_py()
                    if last_doc is not None and last_doc == (d,):  # the batch goes on with the same document
                        f = b.column("first").to_numpy(zero_copy_only=False).copy()
                        f[0] = False
                        b = b.set_column(b.schema.get_field_index("first"), "first", pa.array(f))
                    last_doc = (t.column("doc")[n - 1].as_py(),)
                    yield b
                at_head = n == len(h1)
                t, h1, h2 = t.slice(n), h1[n:], h2[n:]
                if not len(h1):
                    continue
            same = (h1 == h1[-1]) & (h2 == h2[-1])
            tail = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if held and (held[0].column("h1")[0].as_py(), held[0].column("h2")[0].as_py()) == (h1[-1], h2[-1]):
                held.append(t)  # the whole batch continues the run
                continue
            body = pa.concat_tables([*held, t.slice(0, tail)])
            if body.num_rows:
                b = marked(body, False)
                if b is not None:
                    yield b
            held = [t.slice(tail)]
        if held:
            b = marked(pa.concat_tables(held), True)
            if b is not None:
                yield b

    return stream


@F.pandas_udf(T.BinaryType())
def _bitmap(dropped: pd.Series, n_lines: pd.Series) -> pd.Series:
    def one(positions, n):
        keep = np.ones(n, np.uint8)
        keep[np.asarray(positions, np.int64)] = 0
        return zlib.compress(np.packbits(keep).tobytes())

    return pd.Series([one(p, n) for p, n in zip(dropped, n_lines)])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_KEY_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, n_lines, n_dropped, bitmap) for each row that loses lines; the others keep all.

    ``k1, k2`` is ``row_key(id, text)``; the bitmap has one bit per line, 1 for keep, zlib-packed.
    Line hashes are range-partitioned by (hash, document) and sorted by document, largest
    first, and position, so a hash that a third of all lines share is spread over many tasks:
    runs inside a partition are decided there, the two at its ends through one small total
    per (partition, end). Hashes have 128 bits.
    """
    lines = written(line_table(docs, id_col, text_col, min_chars), "line-hashes")
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc_nulls_last()]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order, "pos")
    doc_type = lines.schema["doc"].dataType.simpleString()
    marked = written(
        ranged.mapInArrow(_runs(min_docs), f"k1 long, k2 long, n_lines int, pos int, h1 long, h2 long, doc {doc_type}, edge boolean, first boolean"),
        "line-runs",
    )
    edge = marked.filter("edge")
    # Two rows per partition at most; written, its size is known and Catalyst need not deal the edge rows by hash.
    total = written(edge.groupBy("h1", "h2").agg(F.sum(F.col("first").cast("long")).alias("docs"), F.max("doc").alias("top")), "line-edges")
    cut = edge.join(total.filter(F.col("docs") >= min_docs), ["h1", "h2"]).filter(~F.col("doc").eqNullSafe(F.col("top")))
    gone = marked.filter("NOT edge").select("k1", "k2", "n_lines", "pos").union(cut.select("k1", "k2", "n_lines", "pos"))
    return (
        gone.groupBy("k1", "k2").agg(F.first("n_lines").alias("n_lines"), F.collect_set("pos").alias("dropped"))
        .select("k1", "k2", "n_lines", F.size("dropped").alias("n_dropped"), _bitmap("dropped", "n_lines").alias("bitmap"))
    )


@F.pandas_udf(T.StringType())
def _kept_text(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def one(t, b):
        if b is None:
            return t
        lines = t.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8), count=len(lines))
        return "\n".join([x for x, k in zip(lines, keep.tolist()) if k])

    return pd.Series([one(t, b) for t, b in zip(text, bitmap)], dtype=object)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """``docs`` with repeated lines gone from ``text``, and n_lines, n_dropped added.

    Null and empty texts are one empty line; ties of the largest id keep all its rows' lines; a
    null id counts as one document below all others. Repeated rows and extra columns stay.
    """
    k1, k2, bm, nd, nl, kept = fresh(docs, "llm_k1", "llm_k2", "llm_bitmap", "n_dropped", "n_lines", "llm_kept")
    bitmaps = keep_bitmaps(docs, id_col, text_col, **limits).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("bitmap").alias(bm), F.col("n_dropped").cast("long").alias(nd))
    a, b = row_key(id_col, text_col)
    joined = docs.withColumns({k1: a, k2: b}).join(bitmaps, [k1, k2], "left")
    return (
        joined.withColumns({nl: F.size(line_array(text_col)).cast("long"), kept: _kept_text(F.coalesce(text_col, F.lit("")), bm)})
        .select(*[F.col(kept).alias(c) if c == text_col else docs_col(c) for c in docs.columns],
                F.col(nl), F.coalesce(nd, F.lit(0)).cast("long").alias(nd))
    )


def docs_col(name: str) -> Column:
    return F.col(f"`{name}`")
