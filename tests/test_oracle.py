"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from starmart.plans.catalog import registered
from starmart.plans.oracle import SQL as CORE_SQL
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

QUERIES = registered()
SQL = CORE_SQL


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name])
    assert r["cols_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["match"], r


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["customer_region", "product_category", "revenue", "orders"]
    # flagship's first row at sf0.001 (FIXTURES.md)
    assert (rows[0].customer_region, rows[0].product_category) == ("AMERICA", "LARGE")
    assert rows[0].revenue == pytest.approx(6093014.73) and rows[0].orders == 113
