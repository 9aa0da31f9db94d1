"""Crawl summaries, site maps, run reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from pagelake.operators.frontier import DUPLICATE, FAILED

# Urls in one site-map document, the limit of the sitemaps.org protocol.
SITEMAP_URLS = 50_000


def crawl_summary(attempts: DataFrame) -> DataFrame:
    """Page counts and time span per site from ``attempts(site, url, status, ts)``.

    A duplicate page counts as visited.
    """
    failed = F.col("status") == FAILED
    return attempts.groupBy("site").agg(
        F.count_if(~failed).alias("total_pages"),
        F.count_if(~failed).alias("successful_crawls"),
        F.count_if(failed).alias("failed_crawls"),
        F.count_if(F.col("status") == DUPLICATE).alias("duplicate_pages"),
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
    )


def sitemap(visited: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """``site, url, last_updated``: one row per distinct visited url.

    ``last_updated`` is ``as_of``, or the site's latest ``ts``.
    """
    urls = visited.select("site", "url").distinct()
    if as_of is not None:
        return urls.withColumn("last_updated", F.lit(as_of).cast("timestamp"))
    latest = visited.groupBy("site").agg(F.max("ts").alias("last_updated"))
    return urls.join(latest, "site", "left")


def sitemap_documents(urls: DataFrame, max_urls: int = SITEMAP_URLS) -> DataFrame:
    """``site, part, urls, last_updated``: the site map as documents of bounded size.

    A large site is split over as many parts as it needs, about ``max_urls``
    urls each, so that no row has to hold a whole site.
    """
    sizes = urls.groupBy("site").agg(F.ceil(F.count("url") / F.lit(max_urls)).cast("int").alias("_parts"))
    parted = urls.join(sizes, "site", "left").withColumn(
        "part", F.pmod(F.xxhash64("url"), F.col("_parts")).cast("int")
    )
    return parted.groupBy("site", "part").agg(
        F.array_sort(F.collect_list("url")).alias("urls"), F.max("last_updated").alias("last_updated")
    )


def run_results(requested: DataFrame, summary: DataFrame, run_id: str, root: str) -> DataFrame:
    """One RUN_RESULT row per requested site.

    ``requested`` is the result of ``lookup_sites``; a known site that yielded
    nothing succeeds with no pages and no path.
    """
    counts = summary.select(F.col("site").alias("name"), F.col("total_pages").alias("_pages"))
    joined = requested.join(counts, "name", "left")
    pages = F.coalesce(F.col("_pages"), F.lit(0))
    return joined.select(
        F.lit(run_id).alias("run_id"),
        F.col("name").alias("site"),
        "success",
        F.when(F.col("success"), pages).otherwise(0).alias("pages"),
        F.when(F.col("success") & (pages > 0), F.concat(F.lit(f"{root}/raw/source="), "name")).alias("path"),
        "error",
    )


def run_report(results: DataFrame) -> DataFrame:
    """Successful and failed sites and pages per run."""
    return results.groupBy("run_id").agg(
        F.count_if(F.col("success")).alias("successful_crawls"),
        F.count_if(~F.col("success")).alias("failed_crawls"),
        F.sum("pages").alias("total_pages"),
    )
