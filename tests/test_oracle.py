"""Every registered query equals its DuckDB oracle on the smallest tables."""

import os

import pytest

from oracle_harness import duck, rows

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _names():
    from seqlake.registry import QUERIES
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from seqlake.oracle import ORACLE
    from seqlake.registry import QUERIES
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        pytest.skip("no SQL oracle (checked elsewhere)")
    want = con.sql(ORACLE[name]).df()
    assert rows(got) == rows(want)


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
