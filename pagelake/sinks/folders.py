"""Partitions on a local or mounted disk, written by the tasks themselves.

Without its native library Hadoop's client of such disks starts a ``chmod`` for every file, every checksum file and every folder
it makes, in tasks and once more in the driver's commit. A zone has a folder of few rows for each source and day, so that
was nearly all a write did. Layout, codecs and names are those of Spark's writer; checksum files are left out.
"""

from __future__ import annotations

import os
import shutil
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# What Spark escapes in a folder name, and what it calls the folder of no value.
ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
CODECS = {"none": "none", "uncompressed": "none", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd"}
# Types that a Parquet file of Arrow's holds as one of Spark's does.
PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
         T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The path on disk of a ``file:`` path, None for other stores."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.makeQualified(hadoop).toUri().getPath() if store.getUri().getScheme() == "file" else None


def folder_of(columns: list[str], values: Iterable[str | None]) -> str:
    return "/".join(f"{c.translate(ESCAPED)}={v.translate(ESCAPED) if v else NO_VALUE}" for c, v in zip(columns, values))


def _is_plain(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_is_plain(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _is_plain(kind.elementType)
    if isinstance(kind, T.MapType):
        return _is_plain(kind.keyType) and _is_plain(kind.valueType)
    return type(kind) in PLAIN


def can_hold(df: DataFrame, fmt: str) -> bool:
    """Whether ``replace_folders`` writes such rows; Spark's writer takes the others."""
    codec = df.sparkSession.conf.get("spark.sql.parquet.compression.codec")
    return fmt == "json" or (fmt == "parquet" and codec in CODECS and _is_plain(df.schema))


class JsonLines:
    """A gzip file of the lines in a batch's only column."""

    def __init__(self, path: str):
        self.file, self.gzip = open(path, "wb"), zlib.compressobj(6, zlib.DEFLATED, 31)

    def add(self, batch: pa.RecordBatch) -> None:
        self.file.write(self.gzip.compress(b"".join(line + b"\n" for line in batch.column(0).to_pylist())))

    def close(self) -> None:
        self.file.write(self.gzip.flush())
        self.file.close()


class ParquetRows:
    def __init__(self, path: str, codec: str, notes: dict[str, str]):
        self.path, self.codec, self.notes, self.writer = path, codec, notes, None

    def add(self, batch: pa.RecordBatch) -> None:
        if self.writer is None:
            self.writer = pq.ParquetWriter(
                self.path, batch.schema.with_metadata(self.notes), compression=CODECS[self.codec], store_schema=False)
        self.writer.write_batch(batch.replace_schema_metadata(self.notes))

    def close(self) -> None:
        self.writer.close()


def runs_of(batch: pa.RecordBatch, n: int) -> Iterator[tuple[tuple, int, int]]:
    """Values of the first ``n`` columns, start and length of every run of rows that share them."""
    if batch.num_rows == 0:
        return
    codes = [batch.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for i in range(n)]
    starts = np.append(0, 1 + np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
        yield tuple(batch.column(i)[start].as_py() for i in range(n)), start, end - start


def replace_folders(
    df: DataFrame, path: str, folder: str, fmt: str, partition_by: list[str], json_options: dict[str, str], rows_per_file: int = 0
) -> None:
    """Replace the partitions that ``df`` has rows for, in ``folder``, which is ``path`` on disk.

    Tasks write files beside the zone and name those they ended; the driver moves these in when all are there. So a task
    that is repeated leaves its rows once, and a write that fails leaves the zone as it was.
    """
    spark, n = df.sparkSession, len(partition_by)
    rest = [f for f in df.schema if f.name not in partition_by]
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    notes = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": T.StructType(rest).json()}
    ending = "json.gz" if fmt == "json" else "parquet" if CODECS[codec] == "none" else f"{codec}.parquet"
    names = [f"`{f.name}`" for f in rest]
    values = [F.to_json(F.struct(*names), json_options).cast("binary").alias("line")] if fmt == "json" else names
    ordered = df.sortWithinPartitions(*partition_by).select(*(F.col(c).cast("string").alias(c) for c in partition_by), *values)
    staging = f"{folder}/.staging-{uuid.uuid4().hex}"

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, done = uuid.uuid4().hex, []
        os.makedirs(f"{staging}/{attempt}")
        at, file, room = None, None, 0
        for batch in batches:
            for values, start, length in runs_of(batch, n):
                rows = batch.slice(start, length).select(range(n, batch.num_columns))
                while rows.num_rows:
                    if file is None or values != at or room == 0:
                        if file is not None:
                            file.close()
                        done.append((folder_of(partition_by, values), f"{attempt}/part-{len(done):05d}-{attempt}.c000.{ending}"))
                        to = f"{staging}/{done[-1][1]}"
                        file = JsonLines(to) if fmt == "json" else ParquetRows(to, codec, notes)
                        at, room = values, rows_per_file or -1
                    part = rows.slice(0, room) if room > 0 else rows
                    file.add(part)
                    rows, room = rows.slice(part.num_rows), room - part.num_rows if room > 0 else room
        if file is not None:
            file.close()
        yield pa.RecordBatch.from_pydict({"folder": [f for f, _ in done], "file": [f for _, f in done]}, pa.schema(
            {"folder": pa.string(), "file": pa.string()}))

    os.makedirs(staging)
    try:
        files = defaultdict(list)
        for row in ordered.mapInArrow(write, "folder STRING, file STRING").collect():
            files[row.folder].append(row.file)
        for i, (name, parts) in enumerate(files.items()):
            os.mkdir(f"{staging}/{i}")
            for part in parts:
                os.rename(f"{staging}/{part}", f"{staging}/{i}/{os.path.basename(part)}")
            target = f"{folder}/{name}"
            if os.path.lexists(target):
                shutil.rmtree(target)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            os.rename(f"{staging}/{i}", target)
    finally:
        shutil.rmtree(staging, ignore_errors=True)
    spark.catalog.refreshByPath(path)
