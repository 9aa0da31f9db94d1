"""The training-data queries against their SQL on the smallest test tables; all of them run."""

from pathlib import Path

import brute_path  # noqa: F401
import pytest
from oracle_check import compare, connect

from pagelake.llm.queries import ORACLE

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) is None
