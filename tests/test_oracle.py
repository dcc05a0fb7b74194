"""Every registered query against its SQL twin on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return repr(round(v, 6)) if isinstance(v, float) and math.isfinite(v) else repr(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("key", sorted(queries()))
def test_query(spark, duck, key):
    df = queries()[key](spark, DATA)
    rows = df.collect()
    assert rows
    if key in oracle_sql():
        result = duck.execute(oracle_sql()[key])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert comparable(rows, df.columns) == comparable(result.fetchall(), columns)


def test_entry(spark):
    assert entry(spark).count() > 0
