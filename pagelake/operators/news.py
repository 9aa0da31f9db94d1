"""Articles: filters, search, merging of sources."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from pagelake.functions.dates import published_ts
from pagelake.operators.skew import first_per_group

# The configured search terms and request limits.
KEYWORDS = ("logistics", "supply chain", "freight", "shipping")
DAYS = 1
PAGE_SIZE = 100
LANGUAGE = "en"


def with_published_ts(articles: DataFrame) -> DataFrame:
    return articles.withColumn("published_ts", published_ts(F.col("publishedAt")))


def published_since(articles: DataFrame, as_of: date, days: int | None = None) -> DataFrame:
    """Articles of the last ``days`` days, by whole days; all without ``days``."""
    if days is None:
        return articles
    return articles.filter(F.to_date("published_ts") >= F.date_sub(F.lit(as_of), days))


def in_language(articles: DataFrame, lang: str = LANGUAGE) -> DataFrame:
    return articles.filter(F.col("lang") == lang)


def keyword_filter(
    articles: DataFrame, columns: Sequence[str], terms: Sequence[str] = KEYWORDS
) -> DataFrame:
    """Articles in which any of the columns contains any of the terms, in any case."""
    if not terms:
        return articles
    any_term = "|".join(re.escape(t.lower()).replace("\\ ", " ") for t in terms)
    hit = F.lit(False)
    for column in columns:
        hit = hit | F.coalesce(F.lower(F.col(column)).rlike(any_term), F.lit(False))
    return articles.filter(hit)


def newest_first(articles: DataFrame, page_size: int | None = None) -> DataFrame:
    """Latest articles first; with ``page_size`` only so many (TakeOrderedAndProject)."""
    ordered = articles.orderBy(F.desc_nulls_last("published_ts"), F.asc("url"))
    return ordered if page_size is None else ordered.limit(page_size)


def search(
    articles: DataFrame,
    as_of: date,
    terms: Sequence[str] = KEYWORDS,
    columns: Sequence[str] = ("title", "description", "content"),
    days: int | None = None,
    lang: str = LANGUAGE,
    page_size: int | None = None,
) -> DataFrame:
    """The request a news service answers, over an article table."""
    return (
        articles.transform(in_language, lang)
        .transform(published_since, as_of, days)
        .transform(keyword_filter, columns, terms)
        .transform(newest_first, page_size)
    )


def merge_articles(articles: DataFrame) -> DataFrame:
    """One row per url from articles of all sources: the earliest source, then position, wins.

    ``articles(source_ord, ord, url, error, ...)``. Rows of failed sources and
    rows without a url are dropped.
    """
    usable = articles.filter(F.col("error").isNull() & (F.coalesce("url", F.lit("")) != ""))
    return first_per_group(usable, ["url"], ["source_ord", "ord"])


def in_merge_order(merged: DataFrame) -> DataFrame:
    return merged.orderBy("source_ord", "ord")


def contributing_sources(envelopes: DataFrame) -> DataFrame:
    """One row, ``sources``: names of the sources without an error, in source order.

    ``envelopes(source_ord, origin, feed_url, error)`` has a row per response
    or article; sources collapse first, so the array is as long as the feed list.
    """
    name = F.when(F.col("origin") == "rss", F.concat(F.lit("rss:"), "feed_url")).otherwise(F.col("origin"))
    per_source = (
        envelopes.filter(F.col("error").isNull())
        .groupBy(name.alias("_name")).agg(F.min("source_ord").alias("_ord"))
    )
    return per_source.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_ord", "_name"))), lambda s: s["_name"]).alias("sources")
    )


def merge_summary(envelopes: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: ``sources`` and ``total_articles``."""
    total = merged.agg(F.count(F.lit(1)).alias("total_articles"))
    return contributing_sources(envelopes).unionByName(total, allowMissingColumns=True).agg(
        F.first("sources", ignorenulls=True).alias("sources"),
        F.max("total_articles").alias("total_articles"),
    )
