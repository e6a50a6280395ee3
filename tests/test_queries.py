"""Every query with an SQL form, against DuckDB on the small tables."""

import os
from numbers import Number

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SLOW = {"placement_audit"}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in os.listdir(small):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{small}/{name}'")
    return con


def plain(value):
    if pd.isna(value):
        return None
    if hasattr(value, "year"):
        return str(value)[:10]
    return float(value) if isinstance(value, Number) and not isinstance(value, bool) else value


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(([plain(v) for v in r] for r in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_matches_sql(spark, duck, small, name):
    got = entry.queries()[name](spark, small).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert rows(got) == rows(want)


def test_oracle_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
