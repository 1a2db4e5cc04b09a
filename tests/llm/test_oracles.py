"""Queries against their SQL twins, and what is registered."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from txrisk.llm import registry


def rows(frame, cols):
    frame = frame[cols].convert_dtypes()
    return sorted(str(tuple(None if pd.isna(v) else v for v in r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql_twin(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f.partition('.')[0]} AS SELECT * FROM read_parquet('{SMALL}/{f}')")
    want = con.execute(registry.ORACLE_SQL[name]).df()
    got = registry.QUERIES[name](spark, SMALL).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert rows(got, cols) == rows(want, cols)


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])
    assert set(registry.ORACLE_SQL) <= set(entry.oracle_sql())
