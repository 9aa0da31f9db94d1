import re

import pytest
from pyspark.sql import functions as F

from pagelake.operators import pages as pg, robots, sites as st

URL = "https://example.com"


def config(spark):
    return st.site_table(spark, [
        {"name": "harbour", "url": URL, "dynamic": False, "page_limit": 10},
        {"name": "market", "url": URL, "dynamic": True, "page_limit": 10, "wait_time": 2},
        {"name": "plain", "url": URL, "region": "north"},
        {"name": "plain", "url": "https://second.example"},
    ])


def test_routing_and_defaults(spark):
    rows = {(r.name, r.url): r for r in st.with_defaults(config(spark)).collect()}
    kind = {k: (r.kind, r.page_limit, r.wait_time) for k, r in rows.items()}
    assert kind["harbour", URL] == ("static", 10, 5)
    assert kind["market", URL] == ("dynamic", 10, 2)
    assert kind["plain", URL] == ("static", 100, 5)
    assert rows["plain", URL].extra == {"region": "north"}


def test_selection(spark):
    assert st.select_sites(config(spark), ["plain"]).count() == 2
    assert st.select_sites(config(spark)).count() == 4


def test_lookup_takes_first_and_reports_unknown(spark):
    requests = spark.createDataFrame([("plain",), ("nope",)], "name STRING")
    got = {r.name: (r.success, r.url, r.error) for r in st.lookup_sites(requests, config(spark)).collect()}
    assert got == {
        "plain": (True, URL, None),
        "nope": (False, None, "Website configuration not found for nope"),
    }
    missing = st.unknown_sites(requests, config(spark)).collect()
    assert [tuple(r) for r in missing] == [("nope", False, "Website configuration not found for nope")]


def test_site_extractor(spark):
    pages = spark.createDataFrame(
        [("a", "http://a/", "<h1>A</h1>", "http://a", 1), ("b", "http://b/", "<h1>B</h1>", "http://b", 2)],
        "site STRING, url STRING, html STRING, base_url STRING, fetch_order BIGINT",
    )
    registry = st.Extractors(pg.extract)
    assert registry.apply(pages).count() == 2
    registry.register("b", lambda p: pg.extract(p).withColumn("shout", F.upper("text")))
    got = {r.site: (r.text, r.shout) for r in registry.apply(pages).collect()}
    assert got == {"a": ("A", None), "b": ("B", "B")}


def test_robots(spark):
    urls = spark.createDataFrame(
        [("https://a.b/private/x",), ("https://A.b/public",), ("http://c.d/private/x",), ("https://a.b",)], "url STRING"
    )
    assert robots.robots_filter(urls).count() == 4
    rules = spark.createDataFrame([("a.b", "/private"), ("a.b", ""), ("c.d", None)], "host STRING, disallow STRING")
    got = {r.url for r in robots.robots_filter(urls, rules).collect()}
    assert got == {"https://A.b/public", "http://c.d/private/x", "https://a.b"}
    everything = spark.createDataFrame([("a.b", "/")], "host STRING, disallow STRING")
    assert [r.url for r in robots.robots_filter(urls, everything).collect()] == ["http://c.d/private/x"]


def longest_match(path, rules):
    """Allowed or not, by the longest rule; plain Python."""
    best = (0, True)
    for rule, allow in rules:
        end = rule.endswith("$")
        pattern = ".*".join(re.escape(part) for part in re.split(r"\*+", rule.removesuffix("$"))) + ("$" if end else "")
        if rule and re.match(pattern, path):
            best = max(best, (len(rule), allow))
    return best[1]


def test_robots_longest_rule_decides(spark):
    rules = [("/", True), ("/shop", False), ("/shop/open", True), ("/*.pdf$", False), ("/shop/open/a.pdf", True), ("/x", True), ("/x", False),
             ("/*?s=", False), ("", False), ("/a.b", False), ("/deep/*/end", False), ("/deep/one/e", True), ("/m**n$", False)]
    paths = ["/", "/shop", "/shop/open/1", "/shop/a.pdf", "/shop/open/a.pdf", "/shop/open/b.pdf", "/b.pdf?x", "/x/y", "/q?s=1", "/q?t=1",
             "/a.b", "/aXb", "/deep/one/end", "/deep/one/two/end", "/deep/end", "/mn", "/m1n", "/m1n2", "/shopping"]
    urls = spark.createDataFrame([(f"https://h.x{p}",) for p in paths], "url STRING")
    table = spark.createDataFrame([("H.x", r, a) for r, a in rules] + [("other.x", "/", False)], "host STRING, rule STRING, allow BOOLEAN")
    got = {r.url.removeprefix("https://h.x") for r in robots.robots_filter(urls, table).collect()}
    assert got == {p for p in paths if longest_match(p, rules)}


def test_a_thousand_sites_share_one_parse(spark, tmp_path, plan_of):
    rows = [(f"s{i}", f"http://s{i}/", f"<h1>Title {i}</h1><p>p</p>", f"http://s{i}", i) for i in range(1200)]
    schema = "site STRING, url STRING, html STRING, base_url STRING, fetch_order BIGINT"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.schema(schema).parquet(str(tmp_path / "pages"))
    sites = st.site_table(spark, [{"name": f"s{i}", "url": f"http://s{i}", "extractor": f"kind{i % 3}"} for i in range(1000)])
    registry = st.Extractors(pg.extract)
    for k in range(3):
        registry.register_fields(f"kind{k}", {"label": F.concat(F.lit(f"{k}:"), F.split("text", "\n")[0]), **({"size": F.length("text")} if k else {})})
    registry.register_fields("s1100", {"label": F.lit("own")})
    df = registry.apply(pages, sites)
    plan = plan_of(df)
    assert plan.count("ArrowEvalPython") == 1 and plan.count("FileScan parquet") == 1
    got = {r.site: (r.label, r.size) for r in df.collect()}
    for i in range(1200):
        first = f"Title {i}p"
        want = (f"{i % 3}:{first}", len(first) if i % 3 else None) if i < 1000 else ("own" if i == 1100 else None, None)
        assert got[f"s{i}"] == want


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_lookup_with_and_without_broadcast(spark, threshold, plan_of):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        requests = spark.range(5).select(F.when(F.col("id") < 3, "plain").otherwise("no").alias("name"))
        df = st.lookup_sites(requests, config(spark))
        assert df.filter("success").count() == 3 and df.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
