"""Breadth-first crawl replay over a snapshot of fetched pages.

All sites advance together, one level per step. The HTML is parsed once into a narrow node table before the
first level. What the crawl knows is kept in tables that every level appends to: attempts, bucketed by
(site, url) as the nodes are, and hashes emitted, bucketed by (site, content_hash). So a level shuffles its
own urls and hashes only, and they meet nodes and history bucket by bucket; pages visited per site are carried
on from level to level. The running total per site goes by ranges of the level's rows, so neither a large site
nor a page everybody links to lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from pagelake.functions.text import content_hash
from pagelake.operators.pages import extract, site_links
from pagelake.operators.skew import first_per_group, in_ranges, range_offsets, total_in_range
from pagelake.session import BucketedTable, bucketed_table, materialize, new_scratch

KEY = ["site", "url"]

NEW, DUPLICATE, FAILED = "new", "duplicate", "failed"
NO_LIMIT = (1 << 63) - 1


def with_site(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Pages of known sites with the ``base_url`` of their site."""
    base = sites.select(F.col("name").alias("site"), F.col("url").alias("base_url"))
    return pages.join(base, "site")


def first_fetch(pages: DataFrame) -> DataFrame:
    """A page fetched twice counts with its first fetch."""
    return first_per_group(pages, KEY, ["fetch_order"])


def site_nodes(extracted: DataFrame, mode: str = "prefix", fragments: bool = True) -> DataFrame:
    """``site, url, content_hash, links, fetch_order``; links distinct, in page order."""
    return extracted.select(
        *KEY,
        content_hash(F.col("text")).alias("content_hash"),
        F.array_distinct(site_links(F.col("links"), F.col("base_url"), mode, fragments)).alias("links"),
        "fetch_order",
    )


def next_frontier(expanded: DataFrame, seen: DataFrame) -> DataFrame:
    """``site, url, parent, pos``: linked urls not seen yet, at their first mention.

    ``expanded(site, parent, links)`` has pages in visit order ``parent`` with
    distinct links; ``seen(site, url)`` holds every url attempted so far.
    Mentions collapse before the shuffle, in buffers of fixed width.
    """
    mentions = expanded.select("site", "parent", F.posexplode("links").alias("pos", "url"))
    first = mentions.groupBy(*KEY).agg(
        F.min("parent").alias("parent"), F.min_by("pos", "parent").alias("pos")
    )
    return first.join(seen.select(*KEY), KEY, "left_anti")


def _attempt_level(level: DataFrame, limits: DataFrame) -> DataFrame:
    """Cut the level at each site's page limit and number the visited pages.

    ``level(site, url, parent, pos, content_hash, …)`` as from ``in_ranges`` by (parent, pos);
    ``content_hash`` is null for a failed fetch. ``limits(site, visited,
    page_limit)``. Adds ``visit_order``, null for failures.
    """
    fetched = F.when(F.col("content_hash").isNotNull(), 1).otherwise(0)
    # The site's numbers join the few rows of ranges, not the urls.
    starts = range_offsets(level, ["site"], fetched).join(limits, "site")
    at = F.col("visited") + F.col("_offset") + F.col("_before")
    columns = [c for c in level.columns if c != "_part"]
    return (
        total_in_range(level, ["site"], ["parent", "pos"], fetched, "_before", inclusive=False)
        .join(starts, ["site", "_part"])
        .filter(at < F.col("page_limit"))
        .select(*columns, F.when(F.col("content_hash").isNotNull(), at + 1).alias("visit_order"))
    )


def _with_status(attempted: DataFrame, known: DataFrame | None) -> DataFrame:
    """``new`` for the first page of a hash no earlier page had, else ``duplicate`` or ``failed``.

    The copies of a hash collapse to their first page before hashes are
    compared with the known ones.
    """
    first = (
        attempted.filter(F.col("content_hash").isNotNull())
        .groupBy("site", "content_hash").agg(F.min("visit_order").alias("visit_order"))
        .transform(lambda df: df if known is None else df.join(known, ["site", "content_hash"], "left_anti"))
        .select("site", F.col("visit_order").alias("_key"), F.lit(True).alias("_new"))
    )
    # Failures have no visit order; negative keys, which match nothing, spread them.
    spread_key = F.coalesce("visit_order", -F.pmod(F.xxhash64("url"), F.lit(1 << 31)))
    return attempted.withColumn("_key", spread_key).join(first, ["site", "_key"], "left").withColumn(
        "status",
        F.when(F.col("content_hash").isNull(), FAILED)
        .when(F.col("_new").isNotNull(), NEW)
        .otherwise(DUPLICATE),
    ).drop("_new", "_key")


def replay_nodes(
    nodes: DataFrame,
    sites: DataFrame,
    history: DataFrame | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """``site, url, depth, parent, pos, visit_order, status, content_hash`` of every attempt.

    ``nodes`` as from ``site_nodes``, one row per (site, url);
    ``sites(name, url, page_limit)``. Pages are attempted first in, first out; a
    failed fetch is not visited; a duplicate is visited but neither emitted nor
    expanded; a site stops at its page limit.
    """
    scratch = scratch or new_scratch(nodes.sparkSession, "crawl")
    with bucketed_table(nodes.select(*KEY, "content_hash", "links"), f"{scratch}/nodes", KEY) as table:
        return replay_table(table, sites, history, scratch)


def replay_table(
    nodes: DataFrame, sites: DataFrame, history: DataFrame | None = None, scratch: str | None = None
) -> DataFrame:
    """``replay_nodes`` over columns of a table that is bucketed by (site, url) already."""
    spark = nodes.sparkSession
    scratch = scratch or new_scratch(spark, "crawl")
    with (
        BucketedTable(spark, f"{scratch}/attempts", KEY, ["depth"]) as attempts,
        BucketedTable(spark, f"{scratch}/hashes", ["site", "content_hash"]) as hashes,
    ):
        if history is not None:
            hashes.append(history.select("site", "content_hash").filter("content_hash IS NOT NULL").distinct())
        _replay(nodes, sites, attempts, hashes, scratch)
    narrow = "site STRING, url STRING, parent BIGINT, pos INT, content_hash STRING, visit_order BIGINT, status STRING, depth INT"
    return spark.read.schema(narrow).parquet(f"{scratch}/attempts")


def _replay(nodes: DataFrame, sites: DataFrame, attempts: BucketedTable, hashes: BucketedTable, scratch: str) -> None:
    """Appends every level to ``attempts``, a partition per depth."""
    spark = nodes.sparkSession
    limits = materialize(sites.select(
        F.col("name").alias("site"), F.lit(0).cast("bigint").alias("visited"),
        F.coalesce(F.col("page_limit").cast("bigint"), F.lit(NO_LIMIT)).alias("page_limit"),
    ), f"{scratch}/limits/0")
    frontier = sites.select(F.col("name").alias("site"), "url", F.lit(0).cast("bigint").alias("parent"), F.lit(0).alias("pos"))
    known = nodes.select(*KEY, "content_hash", "links")
    depth = 0
    while True:
        rows = Observation()
        level = in_ranges(
            frontier.join(known, KEY, "left"), ["site"], ["parent", "pos"], f"{scratch}/frontier/{depth}", rows
        )
        if not rows.get["rows"]:
            if not depth:
                attempts.append(_no_attempts(level))
            return
        # Links stay in their own column; what reads the attempts leaves them alone.
        attempts.append(_with_status(_attempt_level(level, limits), hashes.read()).withColumn("depth", F.lit(depth)))
        attempted = attempts.read().filter(F.col("depth") == depth)
        emitted = attempted.filter(F.col("status") == NEW)
        hashes.append(emitted.select("site", "content_hash"))
        visited = attempted.filter(F.col("status") != FAILED).groupBy("site").agg(F.count("url").alias("_more"))
        limits = materialize(
            limits.join(visited, "site", "left")
            .select("site", (F.col("visited") + F.coalesce("_more", F.lit(0))).alias("visited"), "page_limit")
            .filter(F.col("visited") < F.col("page_limit")),
            f"{scratch}/limits/{depth + 1}",
        )
        expanded = emitted.select("site", F.col("visit_order").alias("parent"), "links").join(limits.select("site"), "site")
        frontier = next_frontier(expanded, attempts.read())
        depth += 1


def _no_attempts(level: DataFrame) -> DataFrame:
    return level.select(
        *KEY, "parent", "pos", "content_hash",
        F.lit(None).cast("bigint").alias("visit_order"), F.lit(None).cast("string").alias("status"), F.lit(0).alias("depth"),
    )


def crawl_replay(
    pages: DataFrame,
    sites: DataFrame,
    history: DataFrame | None = None,
    mode: str = "prefix",
    fragments: bool = True,
    scratch: str | None = None,
) -> DataFrame:
    """The crawl of every site over ``pages(site, url, html, fetch_order)``, see ``replay_nodes``."""
    extracted = extract(with_site(pages.select(*KEY, "html", "fetch_order"), sites))
    nodes = first_fetch(site_nodes(extracted, mode, fragments))
    return replay_nodes(nodes, sites, history, scratch)
