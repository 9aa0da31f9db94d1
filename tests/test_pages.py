import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagelake.functions import urls
from pagelake.functions.html import parse_page
from pagelake.functions.text import content_hash
from pagelake.operators import pages as pg
from pagelake.operators.features import page_features
from pagelake.operators.frontier import next_frontier

BASE = "https://harbour.example"
SAMPLE = """<!DOCTYPE html><html><head><title>Harbour hours</title>
<meta name="keywords" content="boats, tides"></head><body>
<h2>Opening   times</h2>
<ul><li><a href="winter">In winter</a></li>
<li><a href="/summer?x=1">In summer</a></li><li><a href="http://tides.example/">Tides</a></li></ul>
<p>The gate, and
the quay.<img src="map.png" alt="Map of the quay"></p></body></html>"""
SAMPLE_TEXT = "Harbour hours\nOpening\ntimes\nIn winter\nIn summerTides\nThe gate, and\nthe quay."
SAMPLE_HASH = hashlib.md5(" ".join(SAMPLE_TEXT.lower().split()).encode()).hexdigest()
RUN_TS = datetime(2025, 1, 1)


def pages_of(spark, *rows):
    data = [(BASE, url, html, BASE, i) for i, (url, html) in enumerate(rows)]
    return spark.createDataFrame(
        data, "site STRING, url STRING, html STRING, base_url STRING, fetch_order BIGINT"
    )


def test_extraction_fixture(spark):
    df = pg.assemble(pages_of(spark, (BASE, SAMPLE)), RUN_TS)
    row = df.withColumn("kept", pg.site_links(F.col("links"), F.col("base_url"))).first()
    assert row.kept == [BASE + "/winter", BASE + "/summer?x=1"]
    assert [tuple(i) for i in row.images] == [(BASE + "/map.png", "Map of the quay")]
    assert row.metadata == {"title": "Harbour hours", "keywords": "boats, tides"}
    assert row.text == SAMPLE_TEXT
    assert row.content_hash == SAMPLE_HASH
    assert row.hash == hashlib.md5(BASE.encode()).hexdigest()


def text(html):
    return parse_page(html, BASE, BASE)["text"]


def meta(html):
    return dict(parse_page(html, BASE, BASE)["metadata"])


@pytest.mark.parametrize("html, want", [
    ("a<b>b</b>c", "abc"),
    ("a<script>x<b>y</b></script>b<style>p{}</style>c", "abc"),
    ("a<!-- no -->b<!DOCTYPE html>c", "abc"),
    ("x &amp; y&copy;&#233;&#x41;&#150;&nosuch;", "x & y©éA–&nosuch"),
    ("<i>x</i>   <i>y</i> \n <i>z</i>", "x y\nz"),
    ("<pre><i>x</i>   <i>y</i></pre>", "x   y"),
    ("a<template>hidden</template><ruby>k<rt>r</rt></ruby>", "ak"),
    ("<p>one<p>two<br>three", "onetwothree"),
    ("<script>never closed", ""),
    ("a</nosuch>b<div/>c", "abc"),
    ("tail &", "tail &"),
])
def test_text_rules(html, want):
    assert text(html) == want


@pytest.mark.parametrize("html, want", [
    ("<title>T</title>", {"title": "T"}),
    ("<title></title>", {"title": None}),
    ("<title>A</title><title>B</title>", {"title": "A"}),
    ("<title>A</title><meta name=title content=B>", {"title": "B"}),
    ("<meta property='og:x' content='1'><meta name='k' content=''>", {"og:x": "1"}),
    ("<meta name='k' property='p' content='1'><meta name='k' content='2'>", {"k": "2"}),
    ("<meta content='1'>", {}),
])
def test_metadata_rules(html, want):
    assert meta(html) == want


def test_links_and_images_rules(spark):
    hrefs = ["", "#top", "javascript:void(0)", "JavaScript:x", "mailto:a@b.c", "//other.example/x",
             "?q=1", "../up", "page#frag", "https://harbour.example.evil/", "http://[bad"]
    html = "".join(f'<a href="{h}">x</a>' for h in hrefs) + "<a>none</a><img src='i.png'><img alt='no'>"
    url = "https://harbour.example/dir/page"
    df = pg.extract(pages_of(spark, (url, html)))
    def kept(**options):
        return df.select(pg.site_links(F.col("links"), F.col("base_url"), **options)).first()[0]

    inside = ["https://harbour.example/dir/page?q=1", "https://harbour.example/up", "https://harbour.example/dir/page#frag"]
    assert kept() == inside + ["https://harbour.example.evil/"]
    assert kept(mode="host") == inside
    assert kept(mode="host", fragments=False)[-1] == "https://harbour.example/dir/page"
    assert [tuple(i) for i in df.first().images] == [("https://harbour.example/i.png", "")]
    with pytest.raises(ValueError):
        kept(mode="other")


def test_unfetched_pages_are_skipped(spark):
    df = pages_of(spark, (BASE, None), (BASE, ""), (BASE, "<p>x"))
    assert [r.text for r in pg.extract(df).collect()] == ["x"]


def test_counts_and_link_table(spark):
    df = pg.extract(pages_of(spark, (BASE, SAMPLE)))
    assert pg.page_counts(df).first()[2:] == (2, 1, 2, len(df.first().text))
    assert [(r.pos, r.dst_url) for r in pg.link_table(df).orderBy("pos").collect()] == [
        (0, BASE + "/winter"), (1, BASE + "/summer?x=1")
    ]


def test_provenance_replaces_columns(spark):
    df = spark.createDataFrame([("value", "old", "harbour", BASE)], "key STRING, crawler STRING, site STRING, base_url STRING")
    row = pg.stamp(df).first()
    assert (row.key, row.crawler, row.source_url) == ("value", "harbour", BASE)
    assert row.timestamp is not None


def test_next_frontier(spark):
    expanded = spark.createDataFrame(
        [("s", 1, ["a", "b"]), ("s", 2, ["c", "b", "d"]), ("t", 1, ["a"])],
        "site STRING, parent BIGINT, links ARRAY<STRING>",
    )
    seen = spark.createDataFrame([("s", "a"), ("t", "b")], "site STRING, url STRING")
    got = {(r.site, r.url, r.parent, r.pos) for r in next_frontier(expanded, seen).collect()}
    assert got == {("s", "b", 1, 1), ("s", "c", 2, 0), ("s", "d", 2, 2), ("t", "a", 1, 0)}


def test_url_columns(spark):
    df = spark.createDataFrame(
        [("HTTPS://u@WWW.a.B:80/x/y?q#f",), ("http://a.b",), ("http://a.b?x",), ("nothing",)], "url STRING"
    )
    got = df.select(urls.host(F.col("url")), urls.path(F.col("url")), urls.strip_fragment(F.col("url"))).collect()
    assert [tuple(r)[:2] for r in got] == [("www.a.b", "/x/y?q"), ("a.b", "/"), ("a.b", "/?x"), ("", "/")]
    assert got[0][2] == "HTTPS://u@WWW.a.B:80/x/y?q"


def test_feature_plan_parses_once_and_shuffles_once(spark, plan_of):
    df = page_features(pages_of(spark, (BASE, SAMPLE)), RUN_TS)
    plan = plan_of(df)
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan
    row = df.first()
    assert row.entities == {} and row.content_hash == SAMPLE_HASH
    # All terms occur once, so they go by term.
    assert row.keywords == [
        "gate", "gate quay", "harbour", "harbour hours", "hours", "hours opening", "opening", "opening times", "quay", "summertides",
    ]


def test_features_of_duplicates(spark):
    other = SAMPLE.replace("<h2>", "<h3>").replace("</h2>", "</h3>")
    df = page_features(pages_of(spark, (BASE, SAMPLE), (BASE + "/copy", other)), RUN_TS)
    assert [r.url for r in df.collect()] == [BASE]
    seen = df.select("site", "content_hash")
    again = page_features(pages_of(spark, (BASE, SAMPLE), (BASE + "/new", "<p>new")), RUN_TS, history=seen)
    assert [r.url for r in again.collect()] == [BASE + "/new"]


def test_hash_agrees_with_text(spark):
    row = pg.assemble(pages_of(spark, (BASE, SAMPLE))).select("content_hash", content_hash(F.col("text"))).first()
    assert row[0] == row[1]


@pytest.mark.parametrize("html, want", [
    ("<p>a<![foo bar]>b</p>", "ab"),
    ("a&#" + "9" * 5000 + ";b", "a\ufffdb"),
    ("a&#x" + "f" * 5000 + ";b", "a\ufffdb"),
    ("a&#0000000000065;b", "aAb"),
    ("a<![CDATA[x]]>b<![if IE]>c<![endif]>d", None),
])
def test_hostile_markup_loses_no_page(spark, html, want):
    rows = pg.extract(pages_of(spark, (BASE, html), (BASE + "/ok", "<p>fine"))).orderBy("fetch_order").collect()
    assert len(rows) == 2 and rows[1].text == "fine" and rows[1].parse_error is None
    assert want is None or rows[0].text == want


def test_filters_reach_the_scan_and_the_parse_runs_once(spark, plan_of, tmp_path):
    pages_of(spark, (BASE, SAMPLE)).write.parquet(str(tmp_path / "pages"))
    df = pg.extract(spark.read.parquet(str(tmp_path / "pages"))).filter(F.col("site") == BASE)
    plan = plan_of(df.select("text", "links", "images"))
    assert plan.count("ArrowEvalPython") == 1
    assert "EqualTo(site," in plan


def test_plain_links_are_not_joined(monkeypatch):
    from urllib.parse import urljoin

    from pagelake.functions import html as parser

    pages = ["https://en.example.org/doc/4?q#f", "HTTP://User@Host:80", "http:///x", "ftp://h/a", "", None, "//h/a/b", "http://[x/"]
    refs = ["/doc/4", "/a/b/", "/a//b", "//h/x", "/", "/a/../b", "/a;p", "/a?q", "/a#f", "a", "/a.b", "/a b", " /a", "/a\n", "/é", ""]

    def joined(page, ref):
        try:
            return urljoin(page or "", ref)
        except ValueError:
            return None

    for page in pages:
        for ref in refs:
            assert parser._resolve(page, ref, parser._origin(page)) == joined(page, ref), (page, ref)
    calls = []
    monkeypatch.setattr(parser, "urljoin", lambda *a: calls.append(a) or urljoin(*a))
    found = parser.parse_page('<a href="/doc/1"></a><a href="x"></a>', pages[0], pages[0])["links"]
    assert [x["url"] for x in found] == ["https://en.example.org/doc/1", "https://en.example.org/doc/x"] and len(calls) == 1
