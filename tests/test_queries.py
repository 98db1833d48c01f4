"""Every named query against its SQL in an independent engine."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from loanlens.config import MODEL_FEATURES

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck(sf):
    db = duckdb.connect()
    for file in os.listdir(sf):
        name = file.removesuffix(".parquet")
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{file}')")
    return db


def lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "-"
        return repr(float(value)) if isinstance(value, (int, float)) else str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    found = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert lines(df.columns, df.collect()) == lines(found.columns, found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)


def test_model_queries(spark, sf):
    assert QUERIES["ml_tree_attrib"](spark, sf).count() == len(MODEL_FEATURES)
