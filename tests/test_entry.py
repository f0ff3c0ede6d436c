"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
import check
from tallybook.plans.oracles import ORACLES
from tallybook.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in check.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    result = duck.execute(entry_module.oracle_sql()[name])
    wanted = check.sorted_rows([c[0] for c in result.description], result.fetchall())
    assert check.sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == wanted


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
