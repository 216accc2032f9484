"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as contract
from oracle import compare
from orderloom.catalog import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        assert df.columns and df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_only_random_results_lack_sql():
    assert set(QUERIES) - set(SQL) == {"o8_random_pick", "f23_uuid_v4", "f26_rand"}


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert result.columns == [
        "year", "month", "month_name_vi", "gross_revenue", "net_revenue", "orders", "unique_customers",
    ]
