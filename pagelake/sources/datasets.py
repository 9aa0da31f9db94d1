"""Datasets by format."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

_BY_SUFFIX = {"json": "json", "jsonl": "json", "parquet": "parquet", "csv": "csv"}
FORMATS = ("json", "parquet", "csv", "text")


def format_of(path: str) -> str:
    """The format a file name tells, after any ``.gz``; ``text`` when it tells none."""
    found = re.search(r"\.([A-Za-z]+)$", re.sub(r"\.gz$", "", path.rstrip("/")))
    return _BY_SUFFIX.get(found.group(1).lower(), "text") if found else "text"


def read_json(spark: SparkSession, path: str, schema, array_files: bool = False) -> DataFrame:
    """JSON Lines, which Spark splits; ``array_files`` reads one JSON array per file, whole."""
    return spark.read.schema(schema).option("multiLine", array_files).json(path)


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header. Nested columns are JSON text in the file, see ``write_dataset``."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    flat = T.StructType([
        T.StructField(f.name, T.StringType() if _is_nested(f) else f.dataType) for f in target
    ])
    raw = (
        spark.read.schema(flat)
        .options(header=True, multiLine=True, escape='"', nullValue="\\N", emptyValue="")
        .csv(path)
    )
    return raw.select(*(
        F.from_json(f.name, f.dataType).alias(f.name) if _is_nested(f) else F.col(f.name) for f in target
    ))


def _is_nested(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Files of any other kind: one row per file, its text in ``raw``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw")


def read_dataset(
    spark: SparkSession, path: str, fmt: str | None = None, schema=None, array_files: bool = False
) -> DataFrame:
    """Read by the given format or by the suffix of the path."""
    fmt = fmt or format_of(path)
    if fmt == "json":
        return read_json(spark, path, schema, array_files)
    if fmt == "parquet":
        return read_parquet(spark, path, schema)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "text":
        return read_raw(spark, path)
    raise ValueError(f"Unsupported format: {fmt}")


def read_zone(
    spark: SparkSession, root: str, zone: str, schema, fmt: str = "json", day: str | None = None, run_id: str | None = None
) -> DataFrame:
    """A zone with its partition columns ``source, year, month, day, run_id, batch_id``; dates are padded strings.

    Filters on them, or ``day`` as ``YYYY-MM-DD`` and ``run_id``, prune directories. Columns of ``schema`` that a
    partition column replaced are left out; a zone that was never written is empty.
    """
    parts = T.StructType.fromDDL("source STRING, year STRING, month STRING, day STRING, run_id STRING, batch_id BIGINT")
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = T.StructType([f for f in declared if f.name not in parts.names] + list(parts))
    try:
        df = spark.read.schema(fields).format(fmt).load(f"{root}/{zone}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], fields)
    if day is not None:
        y, m, d = day.split("-")
        df = df.filter((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d))
    return df if run_id is None else df.filter(F.col("run_id") == run_id)
