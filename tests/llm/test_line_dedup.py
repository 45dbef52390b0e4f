"""Line dedup against brute force on small tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickwatch.llm import linededup

from .conftest import edge_rows

LONG = "This line is long enough to be shared, number %d"


def brute(rows, key_chars=40, documents=5):
    """(doc_id, n_lines, n_dropped, text) of every (doc_id, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= key_chars:
                holders[key(line)].add(doc)
    order = lambda d: (d is not None, d)  # noqa: E731  rows without an id come first
    last = {k: max(d, key=lambda x: order(x) if x is not None else (False, 0)) for k, d in holders.items() if len(d) >= documents}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def mixed_rows(n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lines = [rng.choice([LONG % rng.randrange(200), " \t" + (LONG % 7).upper() + "\r", "short", "", LONG % (1000 + i), "É" * 40, "É" * 39 + "x"])
                 for _ in range(rng.randrange(1, 12))]
        rows.append((rng.choice([i, i, i, i // 3, None]), "\n".join(lines)))
    return rows + rows[:20]


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = linededup.kept_texts(df, linededup.keep_bitmaps(df, **kw))
    return Counter(tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", "text").collect())


@pytest.mark.parametrize("partitions", [1, 8, 40])
def test_equals_brute_force_however_ranges_fall(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = mixed_rows()
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_line_in_all_documents_and_one_repeated_inside_documents(spark, monkeypatch):
    rows = [(i, "\n".join([LONG % 1] * (1 + i % 3) + ["end"])) for i in range(300)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert sum(n for (_, _, dropped, _), n in got.items() if dropped) == 299


def test_many_rows_of_few_ids_are_decided_by_the_join(spark, monkeypatch):
    rows = [(i % 6, LONG % 1 + f"\nown {i}") for i in range(200)] + [(i % 3, LONG % 2 + f"\nown {i}") for i in range(100)]
    batch = linededup.pa.RecordBatch.from_pydict({"h1": [1] * 8, "h2": [1] * 8, "id": [9, 9, 9, 8, 7, 6, 5, 4]})
    monkeypatch.setattr(linededup, "HELD", 2)
    s = linededup._Streamer(5)
    s.run(batch.slice(0, 1), 0, 1, (0, 0))  # the range's first key is always undecided
    s.run(batch, 0, 8, (1, 1))
    s.close()
    assert sum(part.num_rows for part, is_open in s.out if is_open) == 8  # the first key, two held and five more
    assert [part.column(2).to_pylist() for part, is_open in s.out if not is_open] == [[4]]
    assert run(spark, rows) == brute(rows)


def test_edge_rows_empty_table_and_clashing_names(spark, edge, nothing, clashing):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, key_chars=3, documents=2) == brute(rows, 3, 2)
    assert linededup.keep_bitmaps(nothing).count() == 0
    assert linededup.kept_texts(nothing, linededup.keep_bitmaps(nothing)).count() == 0
    named = clashing.withColumnsRenamed({"row": "keep", "id": "h1", "size": "n_lines"})
    got = linededup.kept_texts(named, linededup.keep_bitmaps(named))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_bitmaps(spark):
    rows = [(i, f"{LONG % 1}\nmine {i}") for i in range(6)]
    out = {r.doc_id: r for r in linededup.keep_bitmaps(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sorted(out) == [0, 1, 2, 3, 4]  # the largest keeps all its lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(out[0].keep), np.uint8), count=2)
    assert bits.tolist() == [0, 1] and out[0].n_lines == 2 and out[0].n_dropped == 1


def test_string_ids(spark):
    rows = [(str(i), f"{LONG % 1}\nmine {i}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    out = linededup.kept_texts(df, linededup.keep_bitmaps(df))
    assert {r.doc_id for r in out.collect() if not r.n_dropped} == {"5"}
