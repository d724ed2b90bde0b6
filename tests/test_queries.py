"""Every query against its SQL in DuckDB, at the smallest scale."""

from __future__ import annotations

import math

import duckdb
import pytest

from tilequery.plans.registry import ORACLES, QUERIES
from tilequery.sources.fixtures import DRIVER

SF = "/root/testdata/sf0.001"
SLOW: set[str] = set()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [r.asDict() for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(plain(dict(zip(names, r, strict=True))[c]) for c in df.columns) for r in found.fetchall()]
    assert sorted([tuple(plain(r[c]) for c in df.columns) for r in rows], key=str) == sorted(want, key=str)
