"""Explicit schemas of the lake tables; reads never infer.

They are DDL strings, which every reader, ``from_json`` and ``createDataFrame``
accept, so no session is needed to import them.
"""

SITE = (
    "name STRING, url STRING, dynamic BOOLEAN, page_limit INT, wait_time INT, "
    "extra MAP<STRING,STRING>"
)

PAGE = "site STRING, url STRING, html STRING, fetch_order BIGINT"

LINK = "href STRING, url STRING"
IMAGE = "url STRING, alt_text STRING"

PAGE_RECORD = (
    f"url STRING, hash STRING, text STRING, images ARRAY<STRUCT<{IMAGE}>>, "
    "metadata MAP<STRING,STRING>, html STRING, crawler STRING, "
    "timestamp TIMESTAMP, source_url STRING"
)

TEXT_RECORD = (
    "url STRING, entities MAP<STRING,ARRAY<STRING>>, keywords ARRAY<STRING>, "
    "content_hash STRING, timestamp TIMESTAMP"
)

# Article as the JSON API delivers it, and the response around it.
API_ARTICLE = (
    "source STRUCT<id STRING, name STRING, url STRING>, author STRING, title STRING, "
    "description STRING, content STRING, url STRING, publishedAt STRING"
)
API_ENVELOPE = (
    "source STRING, query STRING, timestamp STRING, error STRING, status STRING, "
    f"totalResults INT, articles ARRAY<STRUCT<{API_ARTICLE}>>"
)

# One <channel> element of an RSS file.
RSS_ITEM = (
    "title STRING, description STRING, summary STRING, content STRING, "
    "`content:encoded` STRING, link STRING, pubDate STRING"
)
RSS_CHANNEL = f"title STRING, link STRING, item ARRAY<STRUCT<{RSS_ITEM}>>"

FETCH_ATTEMPT = "url STRING, attempt INT, ts TIMESTAMP, html STRING, error STRING"
OP_LOG = "logger STRING, operation STRING, ts TIMESTAMP, duration DOUBLE"
MEM_LOG = (
    "logger STRING, ts TIMESTAMP, "
    "usage STRUCT<rss: DOUBLE, vms: DOUBLE, percent: DOUBLE>"
)
ERROR_LOG = (
    "logger STRING, ts TIMESTAMP, error_type STRING, error_message STRING, "
    "traceback STRING, context MAP<STRING,STRING>"
)
RUN_RESULT = (
    "run_id STRING, site STRING, success BOOLEAN, pages BIGINT, path STRING, error STRING"
)
