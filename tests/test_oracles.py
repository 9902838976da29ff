"""All registered queries of the library against their SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, rows_of

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.registered.ORACLES)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    result = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
