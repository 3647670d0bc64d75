"""Every registered query agrees with its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, canonical

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, tables, name):
    df = entry.queries()[name](spark, SF)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name in SQL:
        cursor = tables.execute(SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert got == canonical(cursor.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).columns == ["record", "dob", "permission_collab", "phone"]
