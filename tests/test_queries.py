"""Every registered query with SQL gives the same rows as DuckDB on the same tables."""

import pytest
from compare import difference

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert difference(got, duck.execute(ORACLES[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "late_payment_ratio" in df.columns
