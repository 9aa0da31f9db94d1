"""What files a lake holds."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def inventory(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """``path, length, modificationTime`` of every file under ``root`` whose
    relative path starts with ``prefix``. The contents are not read, and only paths
    that match are listed."""
    start = root.rstrip("/") + "/" + re.sub(r"([\\*?\[\]{}])", r"\\\1", prefix) + "*"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(start)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path STRING, length BIGINT, modificationTime TIMESTAMP")
    return files.select("path", "length", "modificationTime")


def exists(spark: SparkSession, root: str, prefix: str) -> bool:
    return not inventory(spark, root, prefix).isEmpty()
