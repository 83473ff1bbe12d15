"""Every registered analysis runs on the small tables and, where it has an
oracle, equals DuckDB running the SQL on the same parquet files."""

from __future__ import annotations

import math

import duckdb
import pytest

from tidemark.registry import load_all
from tidemark.sources.tables import TABLES

from .conftest import SMALL

REG = load_all()


def _norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", "nan" if isinstance(v, float) and math.isnan(v) else round(float(v), 6))
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat().replace("T", " "))
    return ("s", str(v))


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    import __spark_entry__ as se
    df = se.entry(spark)
    assert df.count() >= 0 and df.columns
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(REG))
def test_analysis_matches_oracle(spark, duck, name):
    a = REG[name]
    df = a.build(spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    if a.sql is None:
        return
    res = duck.execute(a.sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, rows) == _canon(dcols, res.fetchall())
