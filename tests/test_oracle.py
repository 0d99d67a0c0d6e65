"""Every registered query against its SQL in DuckDB, over the smallest tables."""

from __future__ import annotations

import os

import pandas as pd
import pytest

duckdb = pytest.importorskip("duckdb")

from factloom.plans.registry import ORACLE_SQL, QUERIES


def rows(df: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if x is None or x is pd.NaT or x is pd.NA or x != x:
            return None
        return repr(round(float(x), 6)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(map(cell, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, duck, name):
    got, want = QUERIES[name](spark, sf).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
