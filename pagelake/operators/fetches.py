"""Outcome of fetching: first successful attempt, progress, page limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagelake.operators.skew import running_total


def number_attempts(log: DataFrame, max_retries: int, order: list[str | Column]) -> DataFrame:
    """Numbers each url's attempts from 1 and keeps those the retry limit allows.

    The limit reaches the shuffle as a group limit, so a url with very many
    attempts costs ``max_retries`` rows per task.
    """
    by_url = Window.partitionBy("url").orderBy(*order)
    return log.withColumn("attempt", F.row_number().over(by_url)).filter(F.col("attempt") <= max_retries)


def fetch_outcome(attempts: DataFrame, max_retries: int) -> DataFrame:
    """One row per url from ``attempts(url, attempt, html, error)``.

    The first attempt without an error within ``max_retries`` wins; later ones
    never happened. ``html`` is null when all failed.
    """
    ok = F.col("error").isNull()
    by_url = Window.partitionBy("url")
    # The partitioning that numbered the attempts serves this window too.
    seen = attempts.filter(F.col("attempt") <= max_retries).withColumns({
        "_ok": F.min(F.when(ok, F.col("attempt"))).over(by_url), "_last": F.max("attempt").over(by_url),
    })
    decided = F.coalesce("_ok", "_last")
    return seen.filter(F.col("attempt") == decided).select(
        "url",
        F.col("_ok").isNotNull().alias("success"),
        decided.alias("attempts"),
        F.coalesce(F.col("_ok") - 1, F.col("_last")).alias("failed_attempts"),
        F.when(ok, F.col("html")).alias("html"),
    )


def progress(pages: DataFrame, order: str = "fetch_order") -> DataFrame:
    """Pages processed so far within the site; ``order`` is unique in a site, of any type and spacing.

    Only the site and the order are counted; other columns join the count by both.
    """
    keys = ["site", order]
    counted = running_total(pages.select(*keys), ["site"], [order], F.lit(1), "pages_processed")
    return counted if set(pages.columns) == set(keys) else pages.join(counted, keys)


def page_limit_cut(pages: DataFrame, order: str = "fetch_order", limit: str = "page_limit") -> DataFrame:
    """The pages a site may still visit: rows before its ``page_limit``-th page with markup.

    The count never falls along the order, so the cut is one number per site: the
    last admissible order. Only that meets the pages; markup is not shuffled for it.
    """
    visited = F.when(F.coalesce(F.col("html"), F.lit("")) != "", 1).otherwise(0)
    keys = pages.select("site", order, limit, visited.alias("_visited"))
    counted = running_total(keys, ["site"], [order], F.col("_visited"), "_before", inclusive=False)
    last = counted.filter(F.col("_before") < F.col(limit)).groupBy("site").agg(F.max(order).alias("_cut"))
    return pages.join(last, "site").filter(F.col(order) <= F.col("_cut")).select(*pages.columns)
