"""News responses and RSS files as article tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagelake.operators.news import with_published_ts
from pagelake.schemas import API_ENVELOPE, RSS_CHANNEL

def _or_blank(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def read_envelopes(spark: SparkSession, path: str, array_files: bool = False) -> DataFrame:
    return spark.read.schema(API_ENVELOPE).option("multiLine", array_files).json(path)


def api_articles(envelopes: DataFrame, source_ord: int | Column = 0) -> DataFrame:
    """Articles of API responses; a response without articles gives no row."""
    order = source_ord if isinstance(source_ord, Column) else F.lit(source_ord)
    items = envelopes.select(
        F.coalesce("source", F.lit("newsapi")).alias("origin"),
        F.lit(None).cast("string").alias("feed_url"),
        "error",
        order.alias("source_ord"),
        F.posexplode(F.coalesce("articles", F.array())).alias("ord", "a"),
    )
    return items.select(
        "origin", "feed_url", "error", "source_ord", "ord",
        "a.title", "a.description", "a.content", "a.url", "a.publishedAt", "a.author", "a.source",
    ).transform(with_published_ts)


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    """Channels of RSS files with the file they came from."""
    return (
        spark.read.format("xml").option("rowTag", "channel").schema(RSS_CHANNEL).load(path)
        .withColumn("feed_url", F.input_file_name())
    )


def rss_articles(channels: DataFrame, source_ord: int | Column = 1) -> DataFrame:
    """Feed entries in the common article shape; missing values are empty strings.

    ``content`` is the entry's content or else its summary, which RSS calls
    description.
    """
    order = source_ord if isinstance(source_ord, Column) else F.lit(source_ord)
    error = F.col("error") if "error" in channels.columns else F.lit(None).cast("string")
    items = channels.select(
        "feed_url",
        error.alias("error"),
        order.alias("source_ord"),
        F.struct(
            F.lit(None).cast("string").alias("id"),
            _or_blank("title").alias("name"),
            _or_blank("link").alias("url"),
        ).alias("source"),
        F.posexplode(F.coalesce("item", F.array())).alias("ord", "e"),
    )
    return items.select(
        F.lit("rss").alias("origin"), "feed_url", "error", "source_ord", "ord",
        _or_blank("e.title").alias("title"),
        _or_blank(F.coalesce("e.description", "e.summary")).alias("description"),
        _or_blank(F.coalesce("e.content", "e.`content:encoded`", "e.summary", "e.description")).alias("content"),
        _or_blank("e.link").alias("url"),
        _or_blank("e.pubDate").alias("publishedAt"),
        F.lit(None).cast("string").alias("author"),
        "source",
    ).transform(with_published_ts)
