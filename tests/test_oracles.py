"""Every query against its SQL in DuckDB."""

import math

import duckdb
import pytest

from lawloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def same(x):
    return "" if x is None else f"{x:.6g}" if isinstance(x, float) and not math.isnan(x) else str(x)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = sorted(tuple(same(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    rel = duck.sql(ORACLES[name])
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    assert sorted(rel.columns) == sorted(df.columns)
    want = sorted(tuple(same(r[i]) for i in order) for r in rel.fetchall())
    assert got == want
