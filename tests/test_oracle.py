"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from farezone_oracle.compare import compare, duck

from conftest import SF_SMALL

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    from farezone.plans.catalog import QUERIES

    # the optional subpackage tests the queries that SQL can't express by itself
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con, verbose=True)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year_month", "id", "company", "Z", "Zone", "metric", "count"]
    assert df.count() > 0
