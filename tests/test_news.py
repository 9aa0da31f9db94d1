import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pagelake.functions.dates import published_ts
from pagelake.operators import news
from pagelake.plans.news import merge_news
from pagelake.sources import feeds
from pagelake.sources.datasets import read_zone

API = {
    "source": "newsapi", "status": "ok", "totalResults": 2,
    "articles": [
        {"source": {"id": "tide", "name": "Tide Daily"}, "author": "M. Quay", "title": "Ice leaves the bay",
         "description": "Ports open early", "url": "https://tide.example/ice", "publishedAt": "2024-03-05T06:30:00Z"},
        {"source": {"id": None, "name": "Hill Post"}, "author": None, "title": "Snow on the pass",
         "description": "Lorries wait", "url": "https://hill.example/snow", "publishedAt": "2024-03-07T00:00:00Z"},
    ],
}
FAILED = {"source": "newsapi", "query": "barges", "error": "timed out", "articles": []}
RSS = """<?xml version="1.0"?><rss version="2.0"><channel>
<title>Canal Notes</title><link>https://canal.example/feed</link>
<item><title>Lock closed</title><description>Repairs until May</description><link>https://canal.example/lock</link>
<pubDate>Mon, 11 Mar 2024 09:15:00 GMT</pubDate></item>
<item><title>Barge race</title><description>short</description><content>The long report</content><link>https://canal.example/race</link>
<pubDate>Sat, 16 Mar 2024 18:00:00 GMT</pubDate></item>
<item><link>https://canal.example/untitled</link></item>
</channel></rss>"""


def test_api_envelopes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(API) + "\n" + json.dumps(FAILED) + "\n" + '{"source": "newsapi"}\n')
    articles = feeds.api_articles(feeds.read_envelopes(spark, str(tmp_path))).orderBy("ord").collect()
    assert [a.title for a in articles] == ["Ice leaves the bay", "Snow on the pass"]
    assert [a.published_ts for a in articles] == [datetime(2024, 3, 5, 6, 30), datetime(2024, 3, 7)]
    assert articles[0].source.name == "Tide Daily" and articles[0].origin == "newsapi"


def test_array_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([API, FAILED], indent=1))
    assert feeds.api_articles(feeds.read_envelopes(spark, str(tmp_path), array_files=True)).count() == 2


def test_rss(spark, tmp_path):
    (tmp_path / "f.xml").write_text(RSS)
    rows = feeds.rss_articles(feeds.read_rss(spark, str(tmp_path))).orderBy("ord").collect()
    assert [r.title for r in rows] == ["Lock closed", "Barge race", ""]
    assert [r.content for r in rows] == ["Repairs until May", "The long report", ""]
    assert rows[0].published_ts == datetime(2024, 3, 11, 9, 15) and rows[2].published_ts is None
    assert (rows[0].source.name, rows[0].source.url) == ("Canal Notes", "https://canal.example/feed")
    assert rows[0].feed_url.endswith("f.xml") and rows[2].description == ""


def article_rows(spark):
    rows = [
        ("newsapi", None, None, 0, 0, "https://tide.example/ice"),
        ("newsapi", None, None, 0, 1, "https://hill.example/snow"),
        ("rss", "f1", None, 1, 0, "https://canal.example/1"),
        ("rss", "f2", None, 2, 0, "https://canal.example/2"),
        ("rss", "f3", None, 3, 0, "https://canal.example/3"),
        ("rss", "f3", None, 3, 1, "https://tide.example/ice"),
        ("rss", "f3", None, 3, 2, ""),
        ("rss", "f3", None, 3, 3, None),
        ("rss", "f4", "no answer", 4, 0, "https://canal.example/9"),
    ]
    return spark.createDataFrame(
        rows, "origin STRING, feed_url STRING, error STRING, source_ord INT, ord INT, url STRING"
    ).repartition(5)


def test_merge(spark):
    articles = article_rows(spark)
    merged = news.merge_articles(articles)
    order = [(r.source_ord, r.ord) for r in news.in_merge_order(merged).collect()]
    assert order == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 0)]
    summary = news.merge_summary(articles, merged).first()
    assert summary.sources == ["newsapi", "rss:f1", "rss:f2", "rss:f3"] and summary.total_articles == 5


def test_news_run(spark, tmp_path):
    rows = article_rows(spark)
    merged, summary = merge_news([rows.filter("source_ord = 0"), rows.filter("source_ord > 0")], str(tmp_path), datetime(2025, 4, 3))
    assert merged.count() == 5
    stored = read_zone(spark, str(tmp_path), "raw", "url STRING, source_ord INT", day="2025-04-03")
    assert stored.filter("source = 'news_api'").count() == 5
    report = read_zone(spark, str(tmp_path) + "/reports", "news", "sources ARRAY<STRING>, total_articles BIGINT")
    assert report.first().total_articles == 5
    responses = rows.select("source_ord", "origin", "feed_url", "error").unionByName(
        spark.createDataFrame([(9, "rss", "quiet", None)], "source_ord INT, origin STRING, feed_url STRING, error STRING")
    )
    _, summary = merge_news([rows], str(tmp_path / "again"), datetime(2025, 4, 3), responses)
    assert summary.first().sources == ["newsapi", "rss:f1", "rss:f2", "rss:f3", "rss:quiet"]


@pytest.mark.parametrize("text, want", [
    ("2023-01-01T00:00:00Z", datetime(2023, 1, 1)),
    ("2023-01-01T02:00:00+02:00", datetime(2023, 1, 1)),
    ("2023-01-01", datetime(2023, 1, 1)),
    ("Mon, 11 Mar 2024 09:15:00 GMT", datetime(2024, 3, 11, 9, 15)),
    ("1 Jan 2023 05:30:00 +0530", datetime(2023, 1, 1)),
    ("Sun, 1 Jan 2023 00:00 GMT", datetime(2023, 1, 1)),
    ("yesterday", None), ("", None), (None, None),
])
def test_publish_times(spark, text, want):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(published_ts(F.col("t"))).first()[0] == want


def test_search(spark):
    rows = [
        ("u1", "Freight news", None, "en", "2023-01-10T05:00:00Z"),
        ("u2", "other", "the SUPPLY chain", "en", "2023-01-09T00:00:00Z"),
        ("u3", "shipping", None, "de", "2023-01-10T00:00:00Z"),
        ("u4", "shipping", None, "en", "2023-01-08T23:59:59Z"),
        ("u5", "weather", "rain", "en", "2023-01-10T00:00:00Z"),
        ("u6", "logistics", None, "en", "2023-01-10T05:00:00Z"),
    ]
    articles = spark.createDataFrame(rows, "url STRING, title STRING, content STRING, lang STRING, publishedAt STRING")
    articles = articles.transform(news.with_published_ts)
    def found(**options):
        return [r.url for r in news.search(articles, date(2023, 1, 10), columns=["title", "content"], **{"days": 1, **options}).collect()]

    assert found() == ["u1", "u6", "u2"]
    assert found(page_size=2) == ["u1", "u6"]
    assert found(terms=["rain"]) == ["u5"]
    assert found(terms=[]) == ["u1", "u6", "u5", "u2"]


def test_search_plan_has_no_full_sort(spark, plan_of):
    df = spark.range(10).selectExpr("cast(id as string) url", "current_timestamp() published_ts")
    assert "TakeOrderedAndProject" in plan_of(news.newest_first(df, 5))
