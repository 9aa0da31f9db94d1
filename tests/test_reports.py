from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pagelake.operators import oplog, reports
from pagelake.plans.crawl import crawl_sites
from pagelake.operators.sites import site_table
from pagelake.sources.datasets import read_zone
from pagelake.schemas import ERROR_LOG, MEM_LOG, OP_LOG, PAGE_RECORD, TEXT_RECORD

T0 = datetime(2025, 1, 1)
ATTEMPT = "site STRING, url STRING, status STRING, ts TIMESTAMP"


def test_crawl_summary(spark):
    rows = [("s", "p1", "new", T0), ("s", "p2", "duplicate", T0 + timedelta(seconds=5)), ("s", "p3", "failed", T0)]
    got = reports.crawl_summary(spark.createDataFrame(rows, ATTEMPT)).first()
    assert tuple(got) == ("s", 2, 2, 1, 1, T0, T0 + timedelta(seconds=5))
    assert reports.crawl_summary(spark.createDataFrame([], ATTEMPT)).count() == 0


def test_sitemap(spark):
    rows = [("s", "b", "new", T0), ("s", "a", "new", T0 + timedelta(1)), ("s", "a", "new", T0), ("t", "a", "new", T0)]
    visited = spark.createDataFrame(rows, ATTEMPT)
    urls = reports.sitemap(visited)
    assert {tuple(r) for r in urls.collect()} == {
        ("s", "a", T0 + timedelta(1)), ("s", "b", T0 + timedelta(1)), ("t", "a", T0)
    }
    assert {r.last_updated for r in reports.sitemap(visited, T0).collect()} == {T0}
    docs = reports.sitemap_documents(urls).filter("site = 's'").collect()
    assert [d.urls for d in docs] == [["a", "b"]]


def test_sitemap_of_a_large_site_is_split(spark):
    urls = spark.range(1000).select(F.lit("s").alias("site"), F.concat(F.lit("u"), "id").alias("url"), F.lit(T0).alias("last_updated"))
    docs = reports.sitemap_documents(urls, max_urls=100).collect()
    assert len(docs) == 10 and sum(len(d.urls) for d in docs) == 1000
    assert len({u for d in docs for u in d.urls}) == 1000


def test_operation_and_memory_stats(spark):
    ops = spark.createDataFrame([("l", "parse", T0, d) for d in (1.0, 2.0, 6.0)] + [("l", "crawl", T0, 4.0)], OP_LOG)
    got = {r.operation: (r.avg, r.min, r.max, r["count"]) for r in oplog.operation_stats(ops).collect()}
    assert got == {"parse": (3.0, 1.0, 6.0, 3), "crawl": (4.0, 4.0, 4.0, 1)}
    mem = spark.createDataFrame([("l", T0, (r, 0.0, 0.0)) for r in (100.0, 300.0)], MEM_LOG)
    assert tuple(oplog.memory_stats(mem).first()) == ("l", 200.0, 300.0, 100.0)
    errors = spark.createDataFrame([("l", T0 + timedelta(seconds=9), "E", "m", "t", {}), ("x", T0, "E", "m", "t", {})], ERROR_LOG)
    rows = {r.logger: (r.error_count, r.total_duration) for r in oplog.logger_summary(ops, mem, errors).collect()}
    assert rows == {"l": (1, 9.0), "x": (1, 0.0)}


def test_alerts(spark):
    errors = spark.createDataFrame([("a", "a CRITICAL one"), ("b", "Fatal"), ("c", "timeout")], "source STRING, error STRING")
    got = {r.source: (r.subject, r.body) for r in oplog.alerts(errors).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"] == ("CRITICAL ERROR: a", "Critical error in a:\n\na CRITICAL one")


HOME = "https://example.com"


def test_crawl_run(spark, tmp_path):
    pages = spark.createDataFrame([
        ("ok", HOME, '<title>Home</title>\n<p>mail me@example.org </p><a href="/a">x</a><a href="/b">y</a><a href="/c">z</a>', 1),
        ("ok", HOME + "/a", "<p>Alpha page text</p>", 2),
        ("ok", HOME + "/b", "<p>Alpha page  </p><p>text</p>".replace("  </p><p>", " "), 3),
        ("ok", HOME + "/unlinked", "<p>never reached</p>", 4),
        ("other", "https://other.example", "<p>not asked for</p>", 5),
    ], "site STRING, url STRING, html STRING, fetch_order BIGINT")
    sites = site_table(spark, [
        {"name": "ok", "url": HOME}, {"name": "empty", "url": "https://empty.example"},
        {"name": "other", "url": "https://other.example"},
    ])
    root = str(tmp_path)
    results = crawl_sites(pages, sites, root, "run-7", T0, names=["ok", "empty", "nope"])
    got = {r.site: (r.success, r.pages, r.path is not None, r.error) for r in results.collect()}
    assert got == {
        "ok": (True, 3, True, None), "empty": (True, 0, False, None),
        "nope": (False, 0, False, "Website configuration not found for nope"),
    }
    report = reports.run_report(results).first()
    assert tuple(report) == ("run-7", 2, 1, 3)

    raw = read_zone(spark, root, "raw", PAGE_RECORD, day="2025-01-01").collect()
    assert {r.url for r in raw} == {HOME, HOME + "/a"}
    home = next(r for r in raw if r.url == HOME)
    assert home.crawler == "ok" and home.source_url == HOME and home.metadata["title"] == "Home" and home.html
    texts = {r.url: r for r in read_zone(spark, root, "text_processed", TEXT_RECORD).collect()}
    assert set(texts) == {HOME, HOME + "/a"}
    assert texts[HOME].entities == {"EMAIL": ["me@example.org"]}
    assert texts[HOME + "/a"].keywords == ["alpha", "alpha page", "page", "page text", "text"]
    summary = read_zone(spark, root + "/reports", "summary",
                        "site STRING, total_pages BIGINT, failed_crawls BIGINT, duplicate_pages BIGINT").filter("site = 'ok'").first()
    assert (summary.total_pages, summary.failed_crawls, summary.duplicate_pages) == (3, 1, 1)
    sitemap = read_zone(spark, root + "/reports", "sitemap", "site STRING, url STRING")
    assert {r.url for r in sitemap.collect()} == {HOME, HOME + "/a", HOME + "/b"}
    runs = read_zone(spark, root + "/reports", "runs", "run_id STRING, site STRING, success BOOLEAN")
    assert runs.count() == 3

    # A run that is repeated, here after more pages were fetched, replaces its rows; another run adds its own.
    more = pages.unionByName(spark.createDataFrame([("ok", HOME + "/c", "<p>Gamma</p>", 9)], pages.schema))
    crawl_sites(more, sites, root, "run-7", T0, names=["ok", "empty", "nope"])
    crawl_sites(pages, sites, root, "run-8", T0, names=["ok"])
    raw = read_zone(spark, root, "raw", PAGE_RECORD).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in raw} == {"run-7": 3, "run-8": 2}
    runs = read_zone(spark, root + "/reports", "run_report", "successful_crawls BIGINT, failed_crawls BIGINT, total_pages BIGINT")
    assert sorted((r.run_id, r.successful_crawls, r.failed_crawls, r.total_pages) for r in runs.collect()) == [("run-7", 2, 1, 4), ("run-8", 1, 0, 3)]
