"""The driver contract: entry(), queries() and their SQL twins (DuckDB) on sf0.001."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tickwatch.plans import catalog

TABLES = ("events", "orders")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["crypto_id", "anomaly_type", "severity", "detected_at", "current_price",
                          "reference_value", "variation_pct", "description"]
    assert df.count() > 0


def test_every_engine_query_has_sql_twin():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL) and set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want
