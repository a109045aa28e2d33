"""Every registered query against DuckDB on the smallest tables."""

import duckdb
import pytest

from trellis.plans.registry import FLAGSHIP, ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLE_SQL:
        assert rows
        return
    out = duck.sql(ORACLE_SQL[name])
    assert sorted(out.columns) == columns
    at = [out.columns.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in out.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as e

    assert FLAGSHIP in e.queries()
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
