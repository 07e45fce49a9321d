"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import pytest

from check_oracle import compare, connect
from __spark_entry__ import entry, oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
# up to 10,000 values a side the exact two-sample p-value is used, which SQL does not have
NEED_LARGE_SAMPLES = {"ks_pvalue", "data_drift", "data_drift_summary", "prediction_drift"}

pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="benchmark tables are not there")


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) > 60


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    sf_dir = LARGER if name in NEED_LARGE_SAMPLES else SMALL
    got = queries()[name](spark, sf_dir).toPandas()
    want = connect(sf_dir).execute(oracle_sql()[name]).fetchdf()
    assert compare(got, want).startswith("ok")


def test_flagship(spark):
    assert entry(spark).count() > 0
