"""Every catalogue query against its DuckDB oracle on the shared tables
(sf0.001 here; tools/oracle_check.py runs the larger scales)."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from quire.plans import catalogue, oracle  # noqa: E402
from tools.oracle_check import compare, duck  # noqa: E402

SF_DIR = os.environ.get("QUIRE_TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalogue.QUERIES
SQL = oracle.SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], SQL.get(name), SF_DIR)
    assert res["status"] == "ok", res


def test_entry(spark):
    df = entry.entry(spark)
    got = df.collect()
    assert len(got) > 0
    assert df.columns == ["working", "sex", "age", "primaryNeeds", "work", "other"]
