"""ST1-ST3 with an available-now trigger over landed envelopes."""

from __future__ import annotations

import os

from conftest import tick, ticks_df
from tickwatch.operators import detect, flatten
from tickwatch.plans import transform
from tickwatch.sources import envelopes, tables
from tickwatch.streaming import ingest


def _land(spark, root, rows):
    envelopes.land_envelopes(flatten.envelopes_from_ticks(ticks_df(spark, rows)), root)


def test_stream_dedup_and_price_variation_sink(spark, tmp_dir):
    raw, ap = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "anoms")
    rows = [tick(1704067200 + i * 180, "bitcoin", change=7.0 if i % 4 == 0 else 0.0) for i in range(12)]
    _land(spark, raw, rows)
    _land(spark, raw, rows[:4])  # the same files landed again
    q = ingest.start(ingest.stream_ticks(spark, raw), ingest.price_variation_sink(ap),
                     os.path.join(tmp_dir, "ck"), available_now=True)
    q.awaitTermination()
    stored = tables.read_anomalies(spark, ap).collect()
    assert sorted(r.detected_at for r in stored) == [1704067200 + i * 180 for i in (0, 4, 8)]


def test_stream_rolling_metrics_match_batch(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    tp, mp, ap = (os.path.join(tmp_dir, x) for x in ("ticks", "metrics", "anoms"))
    rows = [tick(1704067200 + i * 180, k, price=50.0 + (i % 7), volume=10.0 if i % 50 else 60.0)
            for i in range(300) for k in ("bitcoin", "ethereum")]
    ck = os.path.join(tmp_dir, "ck")
    _land(spark, raw, rows[:400])
    sink = ingest.rolling_metrics_sink(tp, mp, ap, chunk_rows=480)
    ingest.start(ingest.stream_ticks(spark, raw), sink, ck, available_now=True).awaitTermination()
    _land(spark, raw, rows[400:])
    ingest.start(ingest.stream_ticks(spark, raw), sink, ck, available_now=True).awaitTermination()

    expected = transform.metrics(ticks_df(spark, rows))
    got = tables.read_metrics(spark, mp)
    key = ["crypto_id", "collection_timestamp"]
    e = {tuple(r[k] for k in key): r for r in expected.collect()}
    g = {tuple(r[k] for k in key): r for r in got.collect()}
    assert e.keys() == g.keys()
    for k, r in e.items():
        for c in ("price_ma_24h", "volume_ma_24h", "price_ma_15min"):
            assert abs(r[c] - g[k][c]) < 1e-9, (k, c)
    batch_anoms = detect.detect_all(expected, sort=False).count()
    assert tables.read_anomalies(spark, ap).count() == batch_anoms


def test_rolling_sink_replay_is_idempotent(spark, tmp_dir):
    from tickwatch.operators.timecols import add_time_columns

    tp, mp, ap = (os.path.join(tmp_dir, x) for x in ("ticks", "metrics", "anoms"))
    rows = [tick(1704067200 + i * 180, "bitcoin", volume=10.0 if i % 20 else 90.0, change=7.0 if i % 9 == 0 else 0.0)
            for i in range(100)]
    batch = add_time_columns(ticks_df(spark, rows))
    sink = ingest.rolling_metrics_sink(tp, mp, ap, chunk_rows=480)
    sink(batch, 0)
    counts = (spark.read.parquet(tp).count(), tables.read_metrics(spark, mp).count(),
              tables.read_anomalies(spark, ap).count())
    sink(batch, 0)  # the same micro-batch again after a failure
    assert (spark.read.parquet(tp).count(), tables.read_metrics(spark, mp).count(),
            tables.read_anomalies(spark, ap).count()) == counts
    assert counts[0] == 100 and counts[1] == 100 and counts[2] > 0


def _paths(root):
    return [os.path.join(root, x) for x in ("ticks", "metrics", "anoms")]


def _run(spark, paths, rows, batch_id=0, **kw):
    from tickwatch.operators.timecols import add_time_columns

    ingest.rolling_metrics_sink(*paths, **{"chunk_rows": 480, **kw})(add_time_columns(ticks_df(spark, rows)), batch_id)


def _averages(df):
    return sorted((r.crypto_id or "", r.collection_timestamp, r.price_usd, round(r.volume_ma_24h, 9), round(r.price_ma_15min, 9))
                  for r in df.collect())


def _ticks(n, keys, start=0, step=180):
    return [tick(1704067200 + i * step, k, price=50.0 + i % 7, volume=float(1 + (i * 7) % 90)) for i in range(start, n) for k in keys]


def test_a_batch_reads_its_own_keys_tails_only(spark, tmp_dir):
    """A key with much history and a key that ended: the context of a batch is at most the frame, from its keys."""
    paths = _paths(tmp_dir)
    old = _ticks(1500, ["hot"]) + _ticks(10, ["retired"])
    _run(spark, paths, old)
    tail = ingest.Tail(spark, paths[0], 480)
    buckets = list(range(ingest.TAIL_BUCKETS))
    counts = {r.crypto_id: r["count"] for r in tail.before(-1, buckets).groupBy("crypto_id").count().collect()}
    assert counts == {"hot": 480, "retired": 10}
    history = spark.read.parquet(paths[0]).count()
    for i in range(1500, 1506):
        _run(spark, paths, _ticks(i + 1, ["hot"], i))
        assert {r.crypto_id: r["count"] for r in tail.before(-1, buckets).groupBy("crypto_id").count().collect()} == counts
    # Two versions of a touched bucket remain, one of the untouched.
    dirs = [os.path.join(d, x) for d, sub, _ in os.walk(paths[0] + "-tail") for x in sub if x.startswith("batch=")]
    assert len(dirs) <= 4 and spark.read.parquet(paths[0]).count() == history + 6
    assert _averages(tables.read_metrics(spark, paths[1])) == _averages(transform.metrics(ticks_df(spark, old + _ticks(1506, ["hot"], 1500))))


def test_a_batch_replayed_twice_and_a_broken_tail_version(spark, tmp_dir):
    paths = _paths(tmp_dir)
    first, second, third = _ticks(600, ["a", "b"]), _ticks(700, ["a", "b"], 600), _ticks(720, ["a", "b"], 700)
    for rows in (first, second, second, second, third):
        _run(spark, paths, rows)
    want = _averages(transform.metrics(ticks_df(spark, first + second + third)))
    assert _averages(tables.read_metrics(spark, paths[1])) == want
    # A version whose write broke off: too few rows of key a.
    tail, buckets = ingest.Tail(spark, paths[0], 480), list(range(ingest.TAIL_BUCKETS))
    state = tail.before(-1, buckets).collect()
    broken = spark.createDataFrame([(*r, 480, 0, 99, 5) for r in state if r.crypto_id == "a"][:100], ingest._TAIL).withColumn("bucket", ingest._bucket())
    broken.write.mode("append").partitionBy("bucket", "version", "batch").parquet(paths[0] + "-tail")
    assert sorted(map(tuple, tail.before(-1, buckets).collect())) == sorted(map(tuple, state))


def test_late_ticks_a_second_reading_and_a_table_without_tail(spark, tmp_dir):
    paths = _paths(tmp_dir)
    first, second = _ticks(520, ["a", None]), _ticks(560, ["a", None], 520)
    reading = [tick(second[-2][0], "a", price=77.0, volume=5.0)]  # the last second once more
    _run(spark, paths, first)
    os.rename(paths[0] + "-tail", paths[0] + "-tail-of-before")  # as a table written by an earlier release
    _run(spark, paths, second)
    _run(spark, paths, reading)
    got = tables.read_metrics(spark, paths[1])
    want = transform.metrics(ticks_df(spark, first + second + reading))
    assert _averages(got) == _averages(want)
    late = [tick(first[100][0] + 1, "a", price=60.0, volume=9.0)]
    _run(spark, paths, late)
    (row,) = tables.read_metrics(spark, paths[1]).where("price_usd = 60.0").collect()
    (exp,) = transform.metrics(ticks_df(spark, first + late)).where("price_usd = 60.0").collect()
    assert abs(row.volume_ma_24h - exp.volume_ma_24h) < 1e-9


def _lines(spark, rows, broken=()):
    from pyspark.sql import functions as F

    env = flatten.envelopes_from_ticks(ticks_df(spark, rows)).withColumn(envelopes.CORRUPT, F.lit(None).cast("string"))
    bad = spark.createDataFrame([(None, None, b) for b in broken], envelopes.LINE)
    return env.unionByName(bad)


def test_every_landed_row_is_a_tick_or_has_a_reason(spark, tmp_dir):
    out, side = os.path.join(tmp_dir, "ticks"), os.path.join(tmp_dir, "side")
    t0 = 1704067200
    first = [tick(t0 + i * 180, k) for i in range(60) for k in ("bitcoin", None)] + [tick(t0, "bitcoin", price=9.0)]
    second = [tick(t0, "solana"), tick(t0 + 59 * 180 - 3600, "solana"), tick(t0 + 59 * 180 - 3601, "solana"),
              tick(t0 + 59 * 180, "bitcoin", price=5.0), tick(t0 + 60 * 180, "bitcoin"), tick(t0 + 60 * 180, "bitcoin")]
    sink = ingest.ingest_sink(out, side)

    def state():
        got = spark.read.parquet(side).groupBy("batch_id", "reason").count().collect()
        return spark.read.parquet(out).count(), {(r.batch_id, r.reason): r["count"] for r in got}

    sink(_lines(spark, first, ["{broken"]), 0)
    assert state() == (120, {(0, "malformed"): 1, (0, "duplicate"): 1})
    for _ in range(2):  # the second time as a replay
        sink(_lines(spark, second, ["oops", "{"]), 1)
        assert state() == (122, {(0, "malformed"): 1, (0, "duplicate"): 1, (1, "late"): 2, (1, "duplicate"): 2, (1, "malformed"): 2})
    late = spark.read.parquet(side).where("reason = 'late'").orderBy("collection_timestamp").collect()
    assert [r.collection_timestamp for r in late] == [t0, t0 + 59 * 180 - 3601] and '"crypto_id":"solana"' in late[0].line
    assert spark.read.parquet(out).where("collection_timestamp = 1704067200 AND crypto_id = 'bitcoin'").first().price_usd == 9.0
    sink(_lines(spark, []), 2)
    assert state()[0] == 122


def test_a_replay_after_the_side_rows_stores_the_missing_ticks(spark, tmp_dir, monkeypatch):
    out, side = os.path.join(tmp_dir, "ticks"), os.path.join(tmp_dir, "side")
    rows = [tick(1704067200 + i * 180, "bitcoin") for i in range(5)]
    sink = ingest.ingest_sink(out, side)
    written = ingest.write_ticks
    monkeypatch.setattr(ingest, "write_ticks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        sink(_lines(spark, rows + rows[:2]), 0)
    except RuntimeError:
        pass
    monkeypatch.setattr(ingest, "write_ticks", written)
    sink(_lines(spark, rows + rows[:2]), 0)
    assert spark.read.parquet(out).count() == 5 and spark.read.parquet(side).count() == 2
