"""Headline queries on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``; prints one JSON line.

Every query runs twice and the second run counts, so that class loading and
compilation are not measured. Results are computed in full and dropped.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagelake.plans.queries import QUERIES  # noqa: E402
from pagelake.session import build_session  # noqa: E402

HEADLINE = (
    "page_links", "page_text", "text_records", "content_hashes", "dedup_by_source", "dedup_global",
    "document_keywords", "entities_by_label", "next_frontier", "crawl_replay", "fetch_outcome",
    "crawl_summary", "news_merge", "news_search", "operation_stats", "log_parse",
    "round_trip_parquet", "stream_dedup",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = build_session("pagelake-bench", cores=os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    sf = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(sf.group(1)) if sf else sf_dir,
    }))


if __name__ == "__main__":
    main()
