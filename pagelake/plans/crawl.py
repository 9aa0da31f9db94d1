"""The crawl run: pages of the configured sites to zones and reports."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from pagelake.operators.dedup import with_content_hash
from pagelake.operators.features import with_text_features
from pagelake.operators.frontier import KEY, NEW, first_fetch, replay_table, with_site
from pagelake.operators.pages import extract, page_records, site_links, stamp, text_records, with_url_hash
from pagelake.operators.reports import crawl_summary, run_report, run_results, sitemap
from pagelake.operators.sites import lookup_sites
from pagelake.session import BucketedTable, new_scratch
from pagelake.sinks.zones import write_raw, write_report, write_text


def crawl_sites(
    pages: DataFrame,
    sites: DataFrame,
    root: str,
    run_id: str,
    run_ts: datetime,
    names: Iterable[str] | None = None,
    history: DataFrame | None = None,
    mode: str = "prefix",
    fragments: bool = True,
) -> DataFrame:
    """Replay the crawl of the named sites (default all) over ``pages(site, url,
    html, fetch_order)`` and write raw, text, summary, sitemap and run tables. A site
    without a page limit is crawled whole.

    Returns the run's result rows. Pages are parsed once, into a scratch table bucketed by (site, url):
    its narrow columns are the nodes of the replay, its wide ones join the emitted pages in their
    buckets, so markup is shuffled once. All is written under ``run_id``; a run that is
    repeated replaces what it wrote before.
    """
    spark = pages.sparkSession
    wanted = list(names or ())
    requests = (
        spark.createDataFrame([(n,) for n in wanted], "name STRING") if wanted
        else sites.select("name").distinct()
    )
    requested = lookup_sites(requests, sites, page_limit=None)
    chosen = requested.filter("success")
    scratch = new_scratch(spark, "crawl")

    # One row per (site, url) from here on.
    prepared = (
        first_fetch(extract(with_site(pages.select(*KEY, "html", "fetch_order"), chosen)))
        .transform(with_content_hash).transform(with_url_hash).transform(stamp, run_ts)
        .withColumn("links", F.array_distinct(site_links(F.col("links"), F.col("base_url"), mode, fragments)))
    )
    with BucketedTable(spark, f"{scratch}/pages", KEY) as table:
        table.append(prepared, placed=True)
        extracted = table.read()
        attempts = replay_table(
            extracted.select(*KEY, "content_hash", "links"), chosen.select("name", "url", "page_limit"), history, scratch
        ).withColumn("ts", F.lit(run_ts).cast("timestamp"))
        records = extracted.join(attempts.filter(F.col("status") == NEW).select(*KEY), KEY)
        write_raw(page_records(records), root, F.col("crawler"), run_ts, run_id=run_id)
        write_text(
            with_text_features(records).transform(text_records, F.col("site").alias("source")),
            root, F.col("source"), run_ts, run_id=run_id,
        )
    summary = crawl_summary(attempts)
    visited = attempts.filter(F.col("visit_order").isNotNull())
    write_report(summary, root, "summary", F.col("site"), run_ts, run_id=run_id)
    write_report(sitemap(visited, run_ts), root, "sitemap", F.col("site"), run_ts, run_id=run_id)
    results = run_results(requested, summary, run_id, root)
    write_report(results, root, "runs", "crawl", run_ts, run_id=run_id)
    write_report(run_report(results), root, "run_report", "crawl", run_ts, run_id=run_id)
    return results
