"""Hard negatives against brute force over all scores."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwatch.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, step=5):
    taken = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(max(-2.0**26, min(2.0**26, 256 * float(np.float32(x))))) for x in v]
        taken[i] = min(taken.get(i, (label, w)), (label, w))
    out = []
    for a, (label, v) in taken.items():
        if math.fmod(a, step):
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, (_, w) in taken.items() if i != a)
        for s, p in [(-s, i) for s, i in scores if taken[i][0] == label][:5]:
            hits = [(-t, i) for t, i in scores if taken[i][0] != label and 50 * s <= 100 * -t <= 95 * s][:3]
            out.extend((a, p, r, i, s, t) for r, (t, i) in enumerate(hits, 1))
    return sorted(out)


def run(df, step=5, **kw):
    out = hn.hard_negatives(df, f"vec_id % {step} = 0", **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(n=300, dims=6, seed=1, labels=3, spread=0.4, negative_ids=True):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        k = rng.randrange(labels)
        rows.append((i - 20 * negative_ids, [c + rng.gauss(0, spread) for c in centers[k]], rng.choice([k, k, (k + 1) % labels])))
    return rows


@pytest.mark.parametrize("least", [16, 4096])
def test_equals_brute_force_however_rows_are_dealt(spark, monkeypatch, least):
    monkeypatch.setattr(hn, "block_rows", lambda n: least)
    rows = vectors()
    want = brute(rows)
    assert len(want) > 100
    assert run(spark.createDataFrame(rows, SCHEMA)) == want


def test_ties_zeros_and_a_large_group_of_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(hn, "block_rows", lambda n: 64)
    rows = [(i, [1.0, 0.5, 0.0], i % 2) for i in range(150)]
    rows += [(200 + i, [0.75, 0.25 + 0.001 * (i % 3), 0.0], 2 + i % 2) for i in range(100)]
    rows += [(400 + i, [0.0, 0.0, 0.0], i % 3) for i in range(20)] + [(500, [-1.0, -1.0, 2.0], 0), (505, [-1.0, 0.0, 0.0], 1)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_rows_that_take_no_part_repeats_and_odd_vectors(spark):
    rows = vectors(60, labels=2)
    rows += [(None, [1.0] * 6, 0), (1000, None, 0), (1005, [1.0] * 6, None), (1010, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0),
             (1015, [float("nan")] + [1.0] * 5, 0), (1020, [float("inf")] + [1.0] * 5, 1), (1025, [float("-inf")] + [1.0] * 5, 1)]
    rows += [rows[0], rows[0], (rows[5][0], [9.0] * 6, 1), (1030, [], 0), (1035, [1.0, 1.0], 1), (1040, [3e38, -3e38, 0.5, 0.0, 0.0, 0.0], 0),
             (1045, [0.5] * 8, 0), (1046, [0.4] * 8, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "v", "x", "part", "KIND", "p_id"):
        df = df.withColumn(name, F.lit("x"))
    assert run(df) == brute(rows)


def test_no_rows_and_no_positives(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(0, [1.0], 0), (5, [1.0], 1)], SCHEMA)) == []


def test_labels_may_come_from_an_expression(spark):
    rows = vectors(80)
    moved = [(i, v, (k + 1) % 10 if math.fmod(i, 7) == 0 else k) for i, v, k in rows]
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    assert run(spark.createDataFrame(rows, SCHEMA), label=label) == brute(moved)


def test_the_walk_stops_early_and_its_bound_holds():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(4000, 3)) * 256).astype(np.int64)
    lists = hn.SortedLists(np.arange(4000), x)
    for a in np.floor(rng.normal(size=(20, 3)) * 256).astype(np.int64):
        scores, met = x @ a, np.zeros(4000, bool)
        for rows, got, bound in lists.walk(a):
            assert not met[rows].any() and np.array_equal(scores[rows], got)
            met[rows] = True
            assert bound is None or scores[~met].max() <= bound
        assert met.all()
        seen = []
        walk = lists.walk
        lists.walk = lambda a: (seen.append(len(s[0])) or s for s in walk(a))
        best, score = lists.positives(a, -1)
        lists.walk = walk
        assert score.tolist() == sorted(scores.tolist(), reverse=True)[:5]
        assert sum(seen) < 2500


def test_exact_beyond_doubles():
    x = np.array([[hn.MOST, hn.MOST, 1], [hn.MOST, hn.MOST, 2]], np.int64)
    lists = hn.SortedLists(np.arange(2), x)
    a = np.array([hn.MOST, hn.MOST, 1], np.int64)
    assert lists.scores(np.arange(2), a).tolist() == [2 * hn.MOST**2 + 1, 2 * hn.MOST**2 + 2]
