"""Every registered song query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pytest

from cuesheet.jobs.catalog import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES + ["embeddings"]:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    show = lambda v: "null" if v is None else repr(float(v) + 0.0) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), want.columns)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
