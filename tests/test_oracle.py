"""Every bound query against its DuckDB oracle (sf0.001 by default, ORACLE_SF_DIR to change)."""

import os

import pytest

from oracle_check import compare, duck
from rollcall.plans.bindings import QUERIES
from rollcall.plans.oracle_sql import ORACLES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    ok, ns, nd, _, _, detail = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert ok, f"{name}: spark={ns} duck={nd} {detail}"


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert len(df.columns) == 30 and df.count() >= 0
