"""Frames at constant cost, split time frames, ordered rises, and the bucket plan's parts."""

from __future__ import annotations

import math
import random

import pytest
from conftest import tick, ticks_df
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickwatch.operators import detect, rolling
from tickwatch.operators.rolling import add_moving_averages, add_time_frame_average, ordered_rise_stages, row_frames


def close(a, b):
    if a is None or b is None:
        return a is b
    return repr(a) == repr(b) or math.isclose(a, b, rel_tol=1e-12)


def some_ticks(n=900, seed=4, keys=("a", "b", None)):
    rnd = random.Random(seed)
    rows, seq = [], 0
    for key in keys:
        ts = 1_700_000_000
        for _ in range(n):
            ts += rnd.choice([0, 60, 180, 180, 7000])
            rows.append(tick(ts, key, price=None if rnd.random() < 0.1 else float(rnd.randint(1, 60)),
                             volume=float(rnd.randint(1, 900)), seq=seq))
            seq += 1
    return rows


def framed(df, col, n, f=F.avg):
    w = Window.partitionBy("crypto_id").orderBy("collection_timestamp", "seq").rowsBetween(-n, 0)
    return {r.seq: r.v for r in df.withColumn("v", f(col).over(w)).collect()}


@pytest.mark.parametrize("length,chunk_rows", [(33, None), (33, 40), (50, 64), (480, 480), (480, 700)])
def test_block_averages_equal_the_built_in_frame(spark, length, chunk_rows):
    df = ticks_df(spark, some_ticks(), with_seq=True)
    frames = {"p": ("price_usd", length), "v": ("volume_24h_usd", length), "short": ("price_usd", 5)}
    out = add_moving_averages(df, frames, chunk_rows=chunk_rows, with_counts=True, blocks=True)
    assert out.columns == [*df.columns, "p", "p_n", "v", "v_n", "short", "short_n"]
    got = {r.seq: r for r in out.collect()}
    for name, (src, n) in frames.items():
        assert all(close(got[i][name], v) for i, v in framed(df, src, n).items())
        assert {i: r[f"{name}_n"] for i, r in got.items()} == framed(df, src, n, F.count)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -float("inf"), 1e18])
def test_a_bad_reading_stays_in_its_frames_of_blocks(spark, bad):
    rows = [tick(i * 180, "a", volume=bad if i == 600 else float(i % 7 + 1), seq=i) for i in range(1900)]
    df = ticks_df(spark, rows, with_seq=True)
    want = framed(df, "volume_24h_usd", 480)
    got = {r.seq: r.volume_ma_24h for r in add_moving_averages(df, chunk_rows=500, blocks=True).collect()}
    assert all(close(got[i], want[i]) for i in want)
    # Sums of whole numbers: frames without the bad reading are equal to the last bit.
    assert all(got[i] == want[i] for i in want if not 600 <= i <= 1080)


def test_block_averages_cost_no_frame_per_row(spark):
    df = add_moving_averages(ticks_df(spark, some_ticks(50), with_seq=True), blocks=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "RowFrame, -480, currentrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def runs(rows):
    return {k: sorted((r for r in rows if r[1] == k), key=lambda r: (r[0], r[-1])) for k in {r[1] for r in rows}}


@pytest.mark.parametrize("readings,chunk_rows", [(1, None), (2, 7), (5, 6), (10, 9), (10, None), (13, 40)])
def test_ordered_rise_equals_all_pairs(spark, readings, chunk_rows):
    rows = some_ticks(150)
    df = ticks_df(spark, rows, with_seq=True)
    out = row_frames(df, ordered_rise_stages("price_usd", readings, "rise", "peak"), halo=max(readings - 1, 1), chunk_rows=chunk_rows)
    got = {r.seq: (r.rise, r.peak) for r in out.collect()}
    for group in runs(rows).values():
        for i, row in enumerate(group):
            frame = [r[2] for r in group[max(0, i - readings + 1): i + 1] if r[2] is not None]
            pairs = [(b / a, b) for j, b in enumerate(frame) for a in frame[: j + 1]]
            assert got[row[-1]] == (max(pairs) if pairs else (None, None))


def test_ordered_pump_dump_wants_the_minimum_first(spark):
    fall = [tick(i, price=p, seq=i) for i, p in enumerate([100.0, 99.0, 80.0, 85.0])]  # falls, then a small rise
    rise = [tick(i, "b", price=p, seq=i) for i, p in enumerate([80.0, 100.0, 95.0, 90.0])]
    ticks = ticks_df(spark, fall + rise, with_seq=True)
    plain = detect.detect_pump_dump(ticks).collect()
    ordered = detect.detect_pump_dump(ticks, ordered=True).collect()
    assert {(r.crypto_id, r.detected_at) for r in plain} == {("bitcoin", 2), ("bitcoin", 3), ("b", 3)}
    assert [(r.crypto_id, r.detected_at, r.reference_value) for r in ordered] == [("b", 3, 100.0)]


@pytest.mark.parametrize("seconds", [86_400, 7_200, 600, 119, 1])
def test_time_frames_equal_brute_force(spark, seconds):
    rnd = random.Random(seconds)
    rows = []
    for key in ("a", None):
        ts = -200_000  # before 1970 too
        for i in range(220):
            ts += rnd.choice([0, 1, 59, 60, 61, 600, 3599, 3600, 40_000])
            rows.append(tick(ts, key, price=None if rnd.random() < 0.1 else float(rnd.randint(1, 50)), seq=i))
    rows += [(None, *tick(0, "a", price=5.0, seq=1000 + i)[1:]) for i in range(3)]
    out = add_time_frame_average(ticks_df(spark, rows, with_seq=True), "price_usd", "t", seconds=seconds).collect()
    got = {(r.crypto_id, r.seq): r.t for r in out}
    assert len(out) == len(rows)
    for ts, key, *_, seq in rows:
        frame = [] if ts is None else [r[2] for r in rows if r[0] is not None and r[1] == key and ts - seconds <= r[0] <= ts and r[2] is not None]
        assert close(got[key, seq], sum(frame) / len(frame) if frame else None), (ts, key)


def test_one_keys_day_is_spread_over_tasks_and_exchanged_once(spark):
    rows = [tick(i * 30, "hot", price=float(i % 9 + 1), seq=i) for i in range(2880)]
    out = add_time_frame_average(ticks_df(spark, rows, with_seq=True), "price_usd", "t")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        spread = out.select(F.spark_partition_id().alias("p"), "t", "seq").groupBy("p").agg(F.count("t").alias("n"), F.max("seq"))
        assert spread.where("n > 100").count() >= 6
    finally:
        spark.conf.set(key, before)


def test_a_burst_leaves_other_buckets_as_they_are(spark):
    rows = [tick(7200 + i // 20, "hot", seq=i) for i in range(3000)] + [tick(i * 600, k, seq=5000 + i) for i in range(60) for k in ("hot", "x")]
    df = ticks_df(spark, rows, with_seq=True)
    plan, finest = rolling._adaptive_plan(df, "crypto_id", "collection_timestamp", 3600, 200, 20)
    leaf = plan.where("_own IS NOT NULL").collect()
    assert finest == 1 and sum(r._n for r in leaf) == len(rows)
    assert {r._w for r in leaf if r._kv == "x"} == {3600}
    assert {r._tbv for r in leaf if r._kv == "hot" and r._w == 3600} == {0, 1, *range(3, 10)}  # all hours but the burst's
    stage = [lambda w: {"lo": F.min("seq").over(w.rowsBetween(-20, 0))}]
    want = {r.seq: r.lo for r in row_frames(df, stage, halo=20, chunk_rows=None).collect()}
    got = row_frames(df, stage, halo=20, chunk_rows=200)
    assert got.count() == len(rows) and {r.seq: r.lo for r in got.collect()} == want


def test_the_plan_has_no_window_by_key_alone(spark):
    plan = rolling.bucket_plan(ticks_df(spark, some_ticks(20)[:20], with_seq=True))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line or "windowspecdefinition" in line]
    assert windows and all("_run" in line for line in windows)
