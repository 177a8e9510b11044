"""Every query against its SQL twin, over the whole tables at the smallest scale."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert "avg_sentiment" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    got = df.collect()
    statement = oracle_sql().get(name)
    if statement is None:
        assert got
        return
    cursor = duck.execute(statement)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    expected = Counter(tuple(str(row[columns.index(c)]) for c in order) for row in cursor.fetchall())
    assert Counter(tuple(str(row[c]) for c in order) for row in got) == expected
