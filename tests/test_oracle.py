"""Every registered query against its DuckDB twin on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

from conftest import SF001
from sigmesh.plans.registry import load_all
from sigmesh.sources.tables import TABLES

REG = load_all()
SQL_NAMES = sorted(n for n, s in REG.items() if s.sql)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v + 0.0, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", SQL_NAMES)
def test_query_matches_oracle(spark, con, name):
    spec = REG[name]
    df = spec.build(spark, SF001)
    res = con.execute(spec.sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    s_rows = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    d_idx = [dcols.index(c) for c in order]
    d_rows = sorted((tuple(_norm(r[i]) for i in d_idx) for r in res.fetchall()), key=repr)
    assert s_rows == d_rows
