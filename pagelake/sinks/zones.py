"""Writers: datasets by format and the partitioned zones of the lake.

A zone is ``root/zone/source=…/year=…/month=…/day=…/run_id=…/batch_id=…``; Spark's committers write
whole files, the suffix tells the codec. A write replaces the partitions of its own run and batch
and no others, so a run or a batch that is repeated leaves its rows once.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from pagelake.functions.dates import ISO, date_parts
from pagelake.sinks.folders import can_hold, local_folder, replace_folders

RAW, PROCESSED, TEXT_PROCESSED = "raw", "processed", "text_processed"
PARTITIONS = ["source", "year", "month", "day", "run_id", "batch_id"]
FORMATS = ("json", "parquet", "csv")
# A write mode beside Spark's own: replace the partitions that have rows, keep the others.
REPLACE = "replace"
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": ISO}


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    return fmt


def _flat_for_csv(df: DataFrame) -> DataFrame:
    """CSV holds no nested values: they become JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*(
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema
    ))


def write_dataset(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    mode: str = "append",
    partition_by: list[str] | None = None,
    rows_per_file: int = 0,
) -> str:
    """Write ``df`` as gzip JSON Lines, Parquet or gzip CSV with a header.

    ``mode`` is one of Spark's, or ``replace`` for the partitions of ``partition_by`` that ``df`` has rows for.
    """
    check_format(fmt)
    if mode == REPLACE and partition_by and can_hold(df, fmt) and (folder := local_folder(df.sparkSession, path)):
        replace_folders(df, path, folder, fmt, partition_by, JSON_OPTIONS, rows_per_file)
        return path
    writer = (_flat_for_csv(df) if fmt == "csv" else df).write.format(fmt)
    if mode == REPLACE:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if fmt != "parquet":
        writer = writer.option("compression", "gzip")
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', nullValue="\\N", emptyValue='""')
    if fmt == "json":
        writer = writer.options(**JSON_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.save(path)
    return path


def new_run() -> str:
    """A run id that no other run has."""
    return uuid.uuid4().hex


def with_partitions(
    df: DataFrame, source: str | Column, on: date | datetime | Column, run_id: str | None = None, batch_id: int = 0
) -> DataFrame:
    """Adds ``source, year, month, day, run_id, batch_id``; the run is a new one unless it is given."""
    name = F.lit(source) if isinstance(source, str) else source
    day = on if isinstance(on, Column) else F.lit(on)
    return df.withColumns({
        "source": name, **date_parts(day),
        "run_id": F.lit(new_run() if run_id is None else run_id), "batch_id": F.lit(batch_id).cast("bigint"),
    })


def write_zone(
    df: DataFrame,
    root: str,
    zone: str,
    source: str | Column,
    on: date | datetime | Column,
    fmt: str = "json",
    run_id: str | None = None,
    batch_id: int = 0,
    compact: bool = True,
    rows_per_file: int = 0,
) -> str:
    """Write into a zone, partitioned by source, day, run and batch.

    The partitions that ``df`` has rows for are replaced, all others stay; so a write of the same rows
    under the same ``run_id`` and ``batch_id`` may be repeated, and without ``run_id`` every write adds.
    ``compact`` asks AQE to rebalance: rows of one partition meet in files of
    the advisory size, small partitions share a task, and a source with a third
    of the rows is split over many.
    """
    check_format(fmt)
    out = with_partitions(df, source, on, run_id, batch_id)
    if compact:
        # Spark ignores the hint without AQE, and every task would leave a file in every partition.
        on = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        out = out.hint("rebalance", *PARTITIONS) if on else out.repartition(*PARTITIONS)
    return write_dataset(out, f"{root}/{zone}", fmt, REPLACE, PARTITIONS, rows_per_file)


def write_raw(df: DataFrame, root: str, source: str | Column, on, **options) -> str:
    return write_zone(df, root, RAW, source, on, "json", **options)


def write_processed(df: DataFrame, root: str, source: str | Column, on, fmt: str = "json", **options) -> str:
    return write_zone(df, root, PROCESSED, source, on, fmt, **options)


def write_text(df: DataFrame, root: str, source: str | Column, on, **options) -> str:
    return write_zone(df, root, TEXT_PROCESSED, source, on, "json", **options)


def write_report(df: DataFrame, root: str, name: str, source: str | Column, on, **options) -> str:
    """A named report (summary, sitemap, run report, metrics) beside the processed zone."""
    return write_zone(df, f"{root}/reports", name, source, on, "json", **options)


def write_metrics(metrics: DataFrame, root: str, on, run_id: str) -> str:
    """The metrics of a run, ``logger, operation, metric, value``, as its report; a repeated call replaces them."""
    return write_report(metrics, root, "metrics", F.col("logger"), on, run_id=run_id)
