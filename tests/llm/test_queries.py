"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

from collections import Counter

import __spark_entry__ as entry
import duckdb
import pytest
from conftest import SF_MID

from tickwatch.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    df = entry.queries()[name](spark, SF_MID)
    assert sorted(df.columns) == sorted(names)
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(cursor.fetchall())


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
