"""The news run: responses and feeds to one article table."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pagelake.operators.news import merge_articles, merge_summary
from pagelake.session import materialize, new_scratch
from pagelake.sinks.zones import new_run, write_raw, write_report


def merge_news(
    sources: list[DataFrame], root: str, run_ts: datetime, responses: DataFrame | None = None, run_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Merge article tables (see ``api_articles``, ``rss_articles``), write the raw
    zone and the run's summary; returns both.

    ``responses(source_ord, origin, feed_url, error)`` names the sources that
    answered, with or without articles; without it the articles tell. A call with the
    ``run_id`` of an earlier one replaces what that wrote.
    """
    articles = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    merged = materialize(merge_articles(articles), new_scratch(articles.sparkSession, "news"))
    run_id = new_run() if run_id is None else run_id
    write_raw(merged, root, "news_api", run_ts, run_id=run_id)
    summary = merge_summary(articles if responses is None else responses, merged).withColumn(
        "timestamp", F.lit(run_ts).cast("timestamp")
    )
    write_report(summary, root, "news", "news_api", run_ts, run_id=run_id)
    return merged, summary
