"""Small helpers the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.session import materialize, new_scratch

# A word is a run of bytes other than ASCII white space. bytes.split() cuts at the same six bytes.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
ASCII_SPACE = " \t\n\x0b\f\r"
# Text that one step of a word operator holds as Python words at a time.
PIECE_BYTES = 4 << 20


def fresh(df: DataFrame, *labels: str) -> list[str]:
    """Column names that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    return [label if label.lower() not in have else f"{label}_{uuid.uuid4().hex[:8]}" for label in labels]


def row_key(*columns: str) -> list[Column]:
    """Two 64-bit hashes that name a row by its values; never null.

    Rows equal in all ``columns`` share the key, so per-row results joined by it
    reach every repeat, and rows that only share an id stay apart.
    """
    cols = [F.col(c) for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cols])
    return [F.xxhash64(F.lit(seed), nulls, *cols) for seed in (1, 2)]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: cuts the lineage, survives lost executors."""
    return materialize(df, new_scratch(df.sparkSession, label))


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """``data`` in order, cut at white space about every ``size`` bytes, so that no word is cut."""
    start, end = 0, len(data)
    while end - start > size:
        cut = start + size
        while cut < end and data[cut] not in b" \t\n\x0b\f\r":
            cut += 1
        yield data[start:cut]
        start = cut
    yield data[start:]


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; null becomes empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def slices(rows: Sequence[bytes], size: int) -> Iterator[range]:
    """Consecutive row ranges of about ``size`` bytes each, one row at least."""
    start, total = 0, 0
    for i, row in enumerate(rows):
        if i > start and total + len(row) > size:
            yield range(start, i)
            start, total = i, 0
        total += len(row)
    if start < len(rows):
        yield range(start, len(rows))
