"""The page flow as a stream: file source, bounded duplicate state, zones that keep runs apart."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pagelake.operators.dedup import scope_keys
from pagelake.operators.entities import PATTERNS
from pagelake.operators.features import with_text_features
from pagelake.operators.frontier import FAILED, NEW
from pagelake.operators.pages import assemble
from pagelake.operators.reports import crawl_summary, sitemap
from pagelake.session import adaptive
from pagelake.sinks.zones import TEXT_PROCESSED, new_run, write_report, write_zone
from pagelake.sources.datasets import read_zone
from pagelake.streaming.dedup import drop_seen_within

SALTS = 16
ATTEMPTS = "attempts"


def page_stream(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """New files of a folder, at most ``max_files`` or ``max_bytes`` per step."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def drop_seen(stream: DataFrame, scope: str = "site", spread: str = "url", salts: int = SALTS) -> DataFrame:
    """Let one row of each content hash pass, the first to arrive; every hash is kept.

    Copies are first dropped within ``salts`` parts of a
    hash, so a text that is copied without end sends at most ``salts`` rows to
    the task that owns it; ``salts=0`` keeps a single state. ``drop_seen_within`` bounds the state.
    """
    keys = scope_keys(scope)
    if not salts:
        return stream.dropDuplicates(keys)
    salted = stream.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    return salted.dropDuplicates([*keys, "_salt"]).drop("_salt").dropDuplicates(keys)


def stream_to_zone(
    stream: DataFrame, root: str, zone: str, checkpoint: str, fmt: str = "json",
    source: str = "source", event_time: str = "timestamp", run_id: str | None = None,
) -> StreamingQuery:
    """Write a stream into a zone under ``run_id`` and stop when the input is used up.

    Every micro-batch replaces its own partitions, so one that is tried again leaves its rows once, and the zone
    holds streamed and batch-written runs beside each other. ``checkpoint`` belongs to the run: a stream
    that goes on after a failure is started with the same two. Without ``run_id`` a run is a new one.
    """
    run = new_run() if run_id is None else run_id

    def write(batch: DataFrame, batch_id: int) -> None:
        # Spark plans a stream with state without AQE, where a zone's rows are not laid out by partition; the tasks with state are fixed by now.
        with adaptive(batch.sparkSession):
            write_zone(batch, root, zone, F.col(source), F.col(event_time), fmt, run_id=run, batch_id=batch_id)

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def text_stream(
    pages: DataFrame,
    ttl_seconds: int | None = None,
    run_ts=None,
    scope: str = "site",
    patterns: Mapping[str, str] = PATTERNS,
    event_time: str = "fetched_at",
    order: str = "fetch_order",
) -> DataFrame:
    """Streaming pages to streaming text records, with ``site``.

    Extraction and features stay inside the row; only the duplicate state shuffles. With ``ttl_seconds`` a text is forgotten when
    it has not come up for so long by the pages' own ``event_time``, and of the copies of a batch the first by
    ``(event_time, order)`` passes; without it every hash is kept, and any copy of a batch may pass.
    """
    columns = ["site", "content_hash", "url", "timestamp", "text"]
    if ttl_seconds is None:
        unique = drop_seen(assemble(pages, run_ts).select(*columns), scope)
    else:
        narrow = assemble(pages, run_ts).select(*columns, event_time, order)
        unique = drop_seen_within(narrow, ttl_seconds, event_time, order, scope)
    return with_text_features(unique, patterns).drop("text")


def attempt_stream(pages: DataFrame, run_ts=None) -> DataFrame:
    """Streaming ``source, url, status, ts``: one fetch attempt per page, failed without markup."""
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    fetched = F.coalesce(F.col("html"), F.lit("")) != ""
    return pages.select(
        F.col("site").alias("source"), "url",
        F.when(fetched, NEW).otherwise(FAILED).alias("status"), ts.alias("ts"),
    )


def finish_run(
    spark: SparkSession, root: str, run_ts: datetime, run_id: str, text_format: str = "json"
) -> tuple[DataFrame, DataFrame]:
    """Summary and site map of one run, from the attempts and text records its streams have written.

    Call it when the streams have ended; other runs of the day are not read. A page that was fetched and left no text record
    is a duplicate. Both tables are written as reports of the run, which a repeated call replaces, and returned.
    """
    attempts = read_zone(
        spark, root, ATTEMPTS, "url STRING, status STRING, ts TIMESTAMP", run_id=run_id
    ).withColumnRenamed("source", "site")
    emitted = read_zone(spark, root, TEXT_PROCESSED, "content_hash STRING", text_format, run_id=run_id).groupBy(
        F.col("source").alias("site")).agg(F.count("content_hash").alias("_emitted"))
    summary = crawl_summary(attempts).join(emitted, "site", "left").withColumn(
        "duplicate_pages", F.col("total_pages") - F.coalesce("_emitted", F.lit(0))).drop("_emitted")
    urls = sitemap(attempts.filter(F.col("status") != FAILED), run_ts)
    write_report(summary, root, "summary", F.col("site"), run_ts, run_id=run_id)
    write_report(urls, root, "sitemap", F.col("site"), run_ts, run_id=run_id)
    return summary, urls


def batch_metrics(query: StreamingQuery, run_id: str) -> list[tuple[str, int, str, float]]:
    """(run_id, batch_id, metric, value) of the micro-batches that an ended stream still reports."""
    rows = []
    for batch in query.recentProgress:
        figures = {"input_rows": batch["numInputRows"], "state_rows": sum(s["numRowsTotal"] for s in batch["stateOperators"]),
                   **{f"{k}_ms": v for k, v in batch["durationMs"].items()}}
        rows += [(run_id, batch["batchId"], name, float(value)) for name, value in figures.items()]
    return rows
