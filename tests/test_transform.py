"""P6, P7, P8 and the row-frame windows W1-W6."""

from __future__ import annotations

import math
import random

import pandas as pd
import pytest

from conftest import tick, ticks_df
from tickwatch.operators import flatten
from tickwatch.operators.rolling import add_moving_averages, add_time_frame_average, row_frames, lag_stage
from tickwatch.operators.timecols import add_time_columns
from tickwatch.operators.validity import filter_valid
from tickwatch.plans import transform


def _brute_ma(values, n):
    """Average of the current and ``n`` preceding non-null values per row."""
    out = []
    for i in range(len(values)):
        frame = [v for v in values[max(0, i - n): i + 1] if v is not None]
        out.append(sum(frame) / len(frame) if frame else None)
    return out


def _close(a, b, rel=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=rel, abs_tol=1e-9)


def test_explode_and_flatten_skips_empty_and_null_data(spark):
    from tickwatch.schemas import ENVELOPE

    rows = [
        ({"collectionTimestamp": 100, "totalCryptos": 5, "successCount": 1, "failureCount": 4, "errors": []},
         [{"cryptoId": "bitcoin", "usd": 1.0, "brl": 5.0, "usd24hVol": 10.0, "usd24hChange": 0.5,
           "lastUpdatedAt": 40, "collectedAt": 100}]),
        ({"collectionTimestamp": 200, "totalCryptos": 5, "successCount": 0, "failureCount": 5, "errors": ["boom"]}, []),
        ({"collectionTimestamp": 300, "totalCryptos": 5, "successCount": 0, "failureCount": 5, "errors": None}, None),
        ({"collectionTimestamp": 400, "totalCryptos": 5, "successCount": 1, "failureCount": 4, "errors": []},
         [{"cryptoId": None, "usd": 2.0, "brl": 10.0, "usd24hVol": 1.0, "usd24hChange": 0.0,
           "lastUpdatedAt": 340, "collectedAt": 400}]),
    ]
    env = spark.createDataFrame(rows, ENVELOPE)
    out = flatten.explode_and_flatten(env).collect()
    assert [r.collection_timestamp for r in out] == [100, 400]
    assert out[0].crypto_id == "bitcoin" and out[0].price_usd == 1.0 and out[0].collected_at == 100
    assert out[1].crypto_id is None
    assert flatten.explode_and_flatten(env).columns == [
        "collection_timestamp", "crypto_id", "price_usd", "price_brl", "volume_24h_usd",
        "change_24h_pct", "last_updated_at", "collected_at",
    ]


def test_time_columns_utc_boundaries(spark):
    # 2024-01-01 23:59:59 and 2024-01-02 00:00:00 UTC
    df = ticks_df(spark, [tick(1704153599), tick(1704153600)])
    out = add_time_columns(df).orderBy("collection_timestamp").collect()
    assert out[0].collection_datetime == "2024-01-01 23:59:59"
    assert str(out[0].collection_date) == "2024-01-01" and out[0].collection_hour == 23 and out[0].collection_minute == 59
    assert str(out[1].collection_date) == "2024-01-02" and out[1].collection_hour == 0


def test_validity_filter_nulls_fail(spark):
    rows = [tick(1, price=0.0), tick(2, price=-1.0), tick(3, price=None), tick(4, volume=0.0),
            tick(5, volume=None), tick(6, key=None), tick(7)]
    out = filter_valid(ticks_df(spark, rows)).collect()
    assert [r.collection_timestamp for r in out] == [7]


@pytest.mark.parametrize("chunk_rows", [None, 480, 500, 16384])
def test_moving_average_frames_match_brute_force(spark, chunk_rows):
    """Frame edges at rows 6/7 and 481/482, nulls and zeros averaged, ties on
    the timestamp broken by seq; chunked layouts with halos match."""
    rnd = random.Random(7)
    rows, seq = [], 0
    for key, n in (("bitcoin", 1300), ("ethereum", 700), ("solana", 3)):
        ts = 1_700_000_000
        for i in range(n):
            ts += 0 if rnd.random() < 0.05 else 180  # some equal timestamps
            price = None if rnd.random() < 0.03 else (0.0 if rnd.random() < 0.03 else round(rnd.uniform(1, 500), 2))
            rows.append(tick(ts, key, price=price, volume=round(rnd.uniform(1, 900), 2), seq=seq))
            seq += 1
    df = ticks_df(spark, rows, with_seq=True)
    out = add_moving_averages(df, chunk_rows=chunk_rows, bucket_seconds=3600).toPandas()
    assert len(out) == len(rows)
    src = pd.DataFrame(rows, columns=df.columns).sort_values(["crypto_id", "collection_timestamp", "seq"])
    exp = {}
    for key, g in src.groupby("crypto_id"):
        prices = [None if pd.isna(v) else v for v in g["price_usd"]]
        vols = list(g["volume_24h_usd"])
        for s, p24, v24, p15 in zip(g["seq"], _brute_ma(prices, 480), _brute_ma(vols, 480), _brute_ma(prices, 5)):
            exp[s] = (p24, v24, p15)
    for r in out.itertuples():
        e = exp[r.seq]
        got = tuple(None if pd.isna(x) else x for x in (r.price_ma_24h, r.volume_ma_24h, r.price_ma_15min))
        assert all(_close(a, b) for a, b in zip(got, e)), (r.seq, got, e)


def test_first_row_average_is_itself_and_multiplier_bounded(spark):
    rows = [tick(100 + i * 180, volume=float(v), seq=i) for i, v in enumerate([10, 40, 1000])]
    out = add_moving_averages(ticks_df(spark, rows, with_seq=True)).orderBy("seq").collect()
    assert out[0].volume_ma_24h == 10.0
    assert out[1].volume_ma_24h == 25.0
    # multiplier <= number of rows in the frame for non-negative volumes
    for i, r in enumerate(out):
        assert r.volume_24h_usd / r.volume_ma_24h <= i + 1 + 1e-12


def test_averages_before_filter(spark):
    rows = [tick(1, price=10.0, seq=1), tick(2, price=0.0, seq=2), tick(3, price=20.0, seq=3)]
    out = transform.metrics(ticks_df(spark, rows, with_seq=True)).orderBy("seq").collect()
    assert [r.seq for r in out] == [1, 3]
    assert out[1].price_ma_15min == pytest.approx(10.0)  # (10 + 0 + 20) / 3


def test_null_key_forms_own_partition(spark):
    rows = [tick(1, key=None, volume=5.0, seq=1), tick(2, key="a", volume=1.0, seq=2),
            tick(3, key=None, volume=7.0, seq=3)]
    out = add_moving_averages(ticks_df(spark, rows, with_seq=True), chunk_rows=480).orderBy("seq").collect()
    assert out[2].volume_ma_24h == pytest.approx(6.0)
    assert out[1].volume_ma_24h == pytest.approx(1.0)


def test_lag_over_chunks(spark):
    rows = [tick(i, price=float(i), seq=i) for i in range(1, 40)]
    out = row_frames(ticks_df(spark, rows, with_seq=True), [lag_stage("price_usd", 5, "ref")], halo=5,
                     chunk_rows=7).orderBy("seq").collect()
    assert [r.ref for r in out[:6]] == [None] * 5 + [1.0]
    assert all(r.ref == r.price_usd - 5 for r in out[5:])


def test_time_frame_average(spark):
    day = 86_400
    rows = [tick(0, price=1.0), tick(day, price=3.0), tick(day + 1, price=5.0), tick(3 * day, price=7.0)]
    out = add_time_frame_average(ticks_df(spark, rows), "price_usd", "avg_t").orderBy("collection_timestamp").collect()
    assert [r.avg_t for r in out] == [1.0, 2.0, 4.0, 7.0]


def test_chunked_plan_partitions_by_key_and_chunk(spark):
    rows = [tick(i, seq=i) for i in range(10)]
    plan = add_moving_averages(ticks_df(spark, rows, with_seq=True))._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan


def test_per_key_plan_has_one_exchange_and_one_sort(spark):
    rows = [tick(i, seq=i) for i in range(10)]
    df = add_moving_averages(ticks_df(spark, rows, with_seq=True), chunk_rows=None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


@pytest.mark.parametrize("chunk_rows", [5, 6, 7, 13])
def test_chunks_match_one_partition_per_key(spark, chunk_rows):
    """Uneven buckets (empty stretches, a few large ones), tiny chunks and a
    halo equal to the chunk size: a bucket may feed two later chunks."""
    from pyspark.sql import functions as F

    rnd = random.Random(chunk_rows)
    rows, seq = [], 0
    for key in ("a", "b", None):
        ts = 0
        for _ in range(rnd.randint(30, 120)):
            ts += rnd.choice([0, 0, 1, 3, 10, 40, 200])
            rows.append(tick(ts, key, price=float(rnd.randint(1, 99)), seq=seq))
            seq += 1
    df = ticks_df(spark, rows, with_seq=True)
    stages = [
        lag_stage("price_usd", 5, "lag5"),
        lambda w: {"lo": F.min("price_usd").over(w.rowsBetween(-5, 0)), "n": F.count("price_usd").over(w.rowsBetween(-5, 0))},
    ]
    want = {r.seq: (r.lag5, r.lo, r.n) for r in row_frames(df, stages, halo=5, chunk_rows=None).collect()}
    got = row_frames(df, stages, halo=5, chunk_rows=chunk_rows, bucket_seconds=10).collect()
    assert len(got) == len(rows)
    assert {r.seq: (r.lag5, r.lo, r.n) for r in got} == want


def test_bucket_plan_targets(spark):
    from tickwatch.operators.rolling import bucket_plan

    # one key; buckets of 10 s with 8, 1, 1, 4 rows; chunks of 5 rows, halo 5
    sizes = [8, 1, 1, 4]
    rows = [tick(b * 10 + i % 10, "k") for b, n in enumerate(sizes) for i in range(n)]
    plan = {r._tbv: (r._own, list(r._to)) for r in bucket_plan(ticks_df(spark, rows), bucket_seconds=10,
                                                                  chunk_rows=5, halo=5).collect()}
    # offsets 0, 8, 9, 10 -> chunks 0, 1, 1, 2; chunk starts at 0, 8, 10
    assert plan == {0: (0, [1, 2]), 1: (1, [2]), 2: (1, [2]), 3: (2, [])}


def test_bucket_layout_shuffles_rows_once(spark):
    rows = [tick(i * 60, k, seq=i) for i in range(200) for k in ("a", "b")]
    df = add_moving_averages(ticks_df(spark, rows, with_seq=True), chunk_rows=480)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "BroadcastHashJoin" in plan and "_chunk" in plan


@pytest.mark.parametrize("seed", [3, 8])
def test_time_frame_average_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for key in ("a", "b"):
        ts = 0
        for _ in range(150):
            ts += rnd.choice([0, 60, 600, 3600, 20000, 90000])
            rows.append(tick(ts, key, price=None if rnd.random() < 0.1 else float(rnd.randint(1, 50))))
    out = add_time_frame_average(ticks_df(spark, rows), "price_usd", "avg_t").collect()
    assert len(out) == len(rows)
    order = lambda x: (x[0], x[1], repr(x[2]), repr(x[3]))
    got = sorted(((r.crypto_id, r.collection_timestamp, r.price_usd, r.avg_t) for r in out), key=order)
    want = []
    for ts, k, p, *_ in rows:
        frame = [r[2] for r in rows if r[1] == k and ts - 86400 <= r[0] <= ts and r[2] is not None]
        want.append((k, ts, p, sum(frame) / len(frame) if frame else None))
    want.sort(key=order)
    assert len(got) == len(want)
    for g, e in zip(got, want):
        assert g[:3] == e[:3] and _close(g[3], e[3]), (g, e)


def test_hot_key_is_spread_over_tasks(spark):
    """One key with most of the rows: the chunked layout evaluates its windows
    in several shuffle partitions, the per-key layout in one."""
    from pyspark.sql import functions as F

    rows = [tick(i * 60, "hot", seq=i) for i in range(6000)] + [tick(i * 60, k, seq=10_000 + i)
                                                               for i in range(50) for k in ("x", "y")]
    df = ticks_df(spark, rows, with_seq=True)
    stage = [lambda w: {"ma": F.avg("volume_24h_usd").over(w.rowsBetween(-480, 0))}]

    def tasks(out):
        # keep "ma" in use, otherwise the window is pruned away
        hot = out.where(F.col("crypto_id") == "hot").select(F.spark_partition_id().alias("p"), "ma")
        return hot.groupBy("p").agg(F.count("ma").alias("n")).where("n > 0").count()

    key = "spark.sql.adaptive.coalescePartitions.enabled"  # tiny data would be merged into one task
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        assert tasks(row_frames(df, stage, halo=480, chunk_rows=None)) == 1
        assert tasks(row_frames(df, stage, halo=480, chunk_rows=500, bucket_seconds=600)) >= 4
    finally:
        spark.conf.set(key, before)


def test_a_plan_too_large_to_broadcast_gives_the_same_values(spark):
    from pyspark.sql import functions as F

    rows = [tick(i * 700, k, price=float(i % 13 + 1), seq=i * 3 + j) for i in range(300) for j, k in enumerate("abc")]
    df = ticks_df(spark, rows, with_seq=True)
    stage = [lambda w: {"lo": F.min("price_usd").over(w.rowsBetween(-5, 0))}]
    want = {r.seq: r.lo for r in row_frames(df, stage, halo=5, chunk_rows=None).collect()}
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        got = row_frames(df, stage, halo=5, chunk_rows=7, bucket_seconds=600)
        assert {r.seq: r.lo for r in got.collect()} == want
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), 1e18])
def test_a_bad_reading_affects_its_frames_only(spark, bad):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rows = [tick(i * 180, "a", volume=bad if i == 10 else float(i % 7 + 1), seq=i) for i in range(1200)]
    df = ticks_df(spark, rows, with_seq=True)
    frame = Window.partitionBy("crypto_id").orderBy("seq").rowsBetween(-480, 0)
    want = [r.v for r in df.withColumn("v", F.avg("volume_24h_usd").over(frame)).orderBy("seq").collect()]
    got = [r.volume_ma_24h for r in add_moving_averages(df, chunk_rows=500).orderBy("seq").collect()]
    assert list(map(repr, got)) == list(map(repr, want))
    clean = {r.seq: r.t for r in add_time_frame_average(df.where("seq <> 10"), "volume_24h_usd", "t").collect()}
    timed = {r.seq: r.t for r in add_time_frame_average(df, "volume_24h_usd", "t").collect()}
    assert all(timed[i] == clean[i] for i in range(491, 1200))


def test_rows_without_a_time_do_not_refine_the_plan(spark):
    from tickwatch.operators.rolling import _adaptive_plan

    rows = [tick(i * 180, "a", seq=i) for i in range(20)]
    rows += [(None,) + tick(0, "a", seq=100 + i)[1:] for i in range(50)]
    plan, width = _adaptive_plan(ticks_df(spark, rows, with_seq=True), "crypto_id", "collection_timestamp", 3600, 32, 5)
    assert width == 3600 and plan.agg({"_n": "sum"}).first()[0] == 70


def test_hot_hour_is_split_with_finer_buckets(spark):
    """A burst: 3000 rows of one key inside a single hour. The plan is rebuilt
    with one-minute buckets so the burst is spread over several tasks, and
    the frames still match one partition per key."""
    from pyspark.sql import functions as F

    rows = [tick(7200 + i // 2, "hot", price=float(i % 17 + 1), seq=i) for i in range(3000)]
    df = ticks_df(spark, rows, with_seq=True)
    stage = [lambda w: {"lo": F.min("price_usd").over(w.rowsBetween(-20, 0))}]
    want = {r.seq: r.lo for r in row_frames(df, stage, halo=20, chunk_rows=None).collect()}
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        out = row_frames(df, stage, halo=20, chunk_rows=200, bucket_seconds=3600)
        assert {r.seq: r.lo for r in out.collect()} == want
        parts = out.select(F.spark_partition_id().alias("p"), "lo").groupBy("p").agg(F.count("lo").alias("n"))
        assert parts.where("n > 0").count() >= 4
    finally:
        spark.conf.set(key, before)
