"""Every registered query against its SQL on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from oracle_check import compare, connect
from pagelake.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql(spark):
    assert set(QUERIES) <= set(entry_module.queries()) and set(QUERIES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and df.columns == ["site", "content_hash", "url", "timestamp", "keywords", "entities"]


def test_no_cross_join(spark, plan_of):
    # The others run jobs while they are built; their parts are checked by name elsewhere.
    eager = ("stream", "zone", "round_trip", "crawl_replay", "news_run", "api", "rss", "log_parse", "crawl_run", "metrics_run", "raw_files")
    for name, query in QUERIES.items():
        if not name.startswith(eager):
            plan = plan_of(query(spark, SF_DIR))
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
