"""Every registered query against its DuckDB statement (small scale here; the
driver runs the same comparison at sf0.01, see tools/oracle_check.py)."""

import os

import pytest

from conftest import SF_SMALL

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from spillway.plans.catalog import QUERIES  # noqa: E402
from tools.oracle_check import compare, duck  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert r["ok"], r
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0  # no query leaves a cached table behind


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["topic", "partition", "offset", "key", "value"]


def test_sf_dirs_exist():
    assert os.path.isdir(SF_SMALL)
