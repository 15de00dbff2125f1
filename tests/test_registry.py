"""The registered queries against their SQL on the smallest tables.  CHECK_ALL=1 runs every one."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.harness import compare, duck

FOLDER = "/root/testdata/sf0.001"
SOME = ["clean_sales", "rolling_demand", "forward_sums", "popularity_rank", "price_decision", "feature_asof", "psi_all",
        "price_percentile", "sliding_demand", "time_series_folds"]
NAMES = list(oracle_sql()) if os.environ.get("CHECK_ALL") else SOME

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    assert compare(queries()[name](spark, FOLDER), duck(FOLDER), oracle_sql()[name]) is None
