"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def other(sf):
    engine = duckdb.connect()
    for name in os.listdir(sf):
        table = name.removesuffix(".parquet")
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{name}'")
    return engine


def normal(frame):
    def text(value):
        if pd.isna(value):
            return "null"
        if isinstance(value, float):  # also whole numbers in a column that holds nulls
            return str(int(value)) if value.is_integer() else repr(value)
        return str(value)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(text, row)) for row in frame[columns].astype(object).values)


def test_every_answer_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["lang", "piece", "n", "rank"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, other, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.toPandas()
    assert len(got) > 0
    if name in SQL:
        want = other.execute(SQL[name]).df()
        assert len(got) == len(want)
        assert normal(got) == normal(want)
