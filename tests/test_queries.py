"""Every registered query of the engine against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = sorted(p.stem for p in Path(SF).glob("*.parquet"))
SLOW = {"grid_search", "quantile_forest"}
# Bootstrap SQL writes out every day of every resample; the larger tables are compared by the driver.


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def text(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql())))
def test_equals_sql(spark, con, name):
    df = registry.queries()[name](spark, SF)
    cur = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    want = sorted(tuple(text(r[columns.index(c)]) for c in order) for r in cur.fetchall())
    got = sorted(tuple(text(r[c]) for c in order) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - SLOW))
def test_runs_without_oracle(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert {"model", "zone", "pinball"} <= set(df.columns)
    df.collect()
