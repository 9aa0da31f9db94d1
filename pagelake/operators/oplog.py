"""Statistics and alerts over operation, memory and error samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")


def operation_stats(op_log: DataFrame) -> DataFrame:
    return op_log.groupBy("logger", "operation").agg(
        F.avg("duration").alias("avg"),
        F.min("duration").alias("min"),
        F.max("duration").alias("max"),
        F.count("duration").alias("count"),
    )


def memory_stats(mem_log: DataFrame) -> DataFrame:
    return mem_log.groupBy("logger").agg(
        F.avg("usage.rss").alias("avg_rss"),
        F.max("usage.rss").alias("max_rss"),
        F.min("usage.rss").alias("min_rss"),
    )


def logger_summary(op_log: DataFrame, mem_log: DataFrame, error_log: DataFrame) -> DataFrame:
    """Per logger: error count, first and last sample, seconds between them.

    Each log is reduced to one row per logger before the three are combined.
    """
    def span(df: DataFrame, errors) -> DataFrame:
        return df.groupBy("logger").agg(
            F.min("ts").cast("timestamp").alias("start_time"),
            F.max("ts").cast("timestamp").alias("end_time"),
            errors.alias("error_count"),
        )

    none = F.sum(F.lit(0).cast("bigint"))
    spans = [span(op_log, none), span(mem_log, none), span(error_log, F.count(F.lit(1)))]
    return (
        reduce(DataFrame.unionByName, spans)
        .groupBy("logger")
        .agg(
            F.sum("error_count").alias("error_count"),
            F.min("start_time").alias("start_time"),
            F.max("end_time").alias("end_time"),
        )
        .withColumn(
            "total_duration",
            (F.unix_micros("end_time") - F.unix_micros("start_time")) / F.lit(1_000_000.0),
        )
    )


def metrics(op_log: DataFrame, mem_log: DataFrame, error_log: DataFrame) -> DataFrame:
    """``logger, operation, metric, value``: the statistics of all three logs as one long table.

    ``operation`` is null for the figures of a logger as a whole.
    """
    whole = F.lit(None).cast("string").alias("operation")
    counted = operation_stats(op_log).withColumn("count", F.col("count").cast("double"))
    summary = logger_summary(op_log, mem_log, error_log).select("logger", F.coalesce("error_count", F.lit(0)).cast("double").alias("error_count"), "total_duration")
    parts = [
        counted.unpivot(["logger", "operation"], ["avg", "min", "max", "count"], "metric", "value"),
        memory_stats(mem_log).unpivot(["logger"], ["avg_rss", "max_rss", "min_rss"], "metric", "value").select("logger", whole, "metric", "value"),
        summary.unpivot(["logger"], ["error_count", "total_duration"], "metric", "value").select("logger", whole, "metric", "value"),
    ]
    return reduce(DataFrame.unionByName, parts)


def alerts(errors: DataFrame) -> DataFrame:
    """``source, subject, body`` of the errors that are critical or fatal, in any case."""
    message = F.lower("error")
    critical = F.contains(message, F.lit("critical")) | F.contains(message, F.lit("fatal"))
    return errors.filter(critical).select(
        "source",
        F.concat(F.lit("CRITICAL ERROR: "), "source").alias("subject"),
        F.concat(F.lit("Critical error in "), "source", F.lit(":\n\n"), "error").alias("body"),
    )


def at_least(log: DataFrame, level: str) -> DataFrame:
    """Log rows of a level or above."""
    return log.filter(F.col("level").isin(list(LEVELS[LEVELS.index(level):])))
