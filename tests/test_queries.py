"""Every registered query against its SQL, on the smallest data folder."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from leadlake.plans.inputs import BASE_TABLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def shown(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def test_entry_and_registry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["place_id", "name", "metro", "deficiency_score", "primary_deficiency", "review_count"] and df.limit(1).count() == 1
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, other, name):
    df = entry_module.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(row[c]) for c in columns) for row in df.collect())
    assert got, "a query must return rows"
    sql = entry_module.oracle_sql().get(name)
    if sql is not None:
        result = other.execute(sql)
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert got == sorted(tuple(shown(dict(zip(names, row))[c]) for c in columns) for row in result.fetchall())
