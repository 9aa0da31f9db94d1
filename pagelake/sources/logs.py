"""Log files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: "time - logger - LEVEL - message".
LINE = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d{3}) - (.+?) - ([A-Z]+) - (.*)$"
TIME = "yyyy-MM-dd HH:mm:ss,SSS"


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def parse_log(lines: DataFrame) -> DataFrame:
    """``ts, logger, level, message, line``.

    A line of another shape, as in a traceback, keeps null fields.
    """
    def group(i: int):
        return F.regexp_extract("line", LINE, i)

    is_entry = F.col("line").rlike(LINE)
    return lines.select(
        F.when(is_entry, F.try_to_timestamp(group(1), F.lit(TIME))).alias("ts"),
        F.when(is_entry, group(2)).alias("logger"),
        F.when(is_entry, group(3)).alias("level"),
        F.when(is_entry, group(4)).alias("message"),
        "line",
    )
