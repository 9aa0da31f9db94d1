"""Exact duplicate removal by content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagelake.functions.bloom import bloom_words, might_hold
from pagelake.functions.text import content_hash
from pagelake.operators.skew import first_per_group, top_n_per_group


def scope_keys(scope: str) -> list[str]:
    if scope == "site":
        return ["site", "content_hash"]
    if scope == "global":
        return ["content_hash"]
    raise ValueError(f"Unsupported scope: {scope}")


def with_content_hash(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("content_hash", content_hash(F.col(text)))


def drop_duplicates(
    df: DataFrame,
    order: Sequence[str | Column] = ("fetch_order",),
    scope: str = "site",
    history: DataFrame | None = None,
    history_filter: HistoryFilter | None = None,
) -> DataFrame:
    """Keep the first row of each content hash, per site or overall.

    ``history`` holds the hashes of earlier runs. It is joined after the copies
    of this run are gone, so no join key is hot. With its ``history_filter`` only rows whose hash the
    filter may hold meet the history; the result is the same.
    """
    keys = scope_keys(scope)
    kept = first_per_group(df, keys, order)
    if history is None:
        return kept
    if history_filter is None:
        return kept.join(history.select(*keys), keys, "left_anti")
    # A column of its own, so that the optimizer does not merge the two ways.
    marked = kept.withColumn("_maybe", history_filter.might_hold([F.col(k) for k in keys]))
    checked = marked.filter("_maybe").join(history.select(*keys), keys, "left_anti")
    return marked.filter("NOT _maybe").unionByName(checked).drop("_maybe")


class HistoryFilter:
    """What may be in a history of hashes, as a table ``word, bits`` that runs add to.

    Every run writes the words of its own new hashes; reading merges them. A filter that forgets is
    made anew from the history that ``update_history`` left.
    """

    def __init__(self, spark: SparkSession, path: str, bits: int, scope: str = "site"):
        self.spark, self.path, self.bits, self.keys = spark, path, bits, scope_keys(scope)

    def add(self, hashes: DataFrame, run_id: str) -> None:
        """Adds the hashes of a run; a run that is repeated replaces its words."""
        words = bloom_words(hashes, self.keys, self.bits).withColumn("run_id", F.lit(run_id))
        words.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(self.path)

    def words(self) -> DataFrame:
        return self.spark.read.schema("word INT, bits BIGINT, run_id STRING").parquet(self.path).select("word", "bits")

    def might_hold(self, key: list[Column]) -> Column:
        return might_hold(self.words(), key, self.bits)


def duplicate_groups(df: DataFrame, id_col: str, keys: Sequence[str] = ("content_hash",)) -> DataFrame:
    """Size and first id of every group with more than one member."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(id_col).alias("first_id"))
        .filter(F.col("copies") > 1)
    )


def update_history(
    history: DataFrame, kept: DataFrame, max_hashes: int | None = None, seen_at: str = "seen_at"
) -> DataFrame:
    """Earlier and new hashes; with ``max_hashes`` only the latest so many of each site."""
    cols = ["site", "content_hash", seen_at]
    merged = (
        history.select(*cols).unionByName(kept.select(*cols))
        .groupBy("site", "content_hash").agg(F.max(seen_at).alias(seen_at))
    )
    if max_hashes is None:
        return merged
    return top_n_per_group(
        merged, ["site"], [F.desc(seen_at), F.asc("content_hash")], max_hashes, ["content_hash"]
    )
