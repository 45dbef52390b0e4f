"""S1-S13 and the ingestion operators P1-P5, P9, J1, J2."""

from __future__ import annotations

import datetime as dt
import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import tick, ticks_df
from tickwatch.operators import flatten
from tickwatch.operators.timecols import landing_key
from tickwatch.plans import reports
from tickwatch.schemas import METRICS, RUN_LOG_STRINGS
from tickwatch.sources import envelopes, market_chart, price_answer, run_log, tables

ANSWER = {
    "bitcoin": {"usd": 70956.0, "brl": 370185.0, "usd_24h_vol": 40022567994.55898, "usd_24h_change": 2.09,
                "last_updated_at": 1770586071},
    "ethereum": {"usd": 2110.0, "brl": 11000.0, "usd_24h_vol": 18.69e9, "usd_24h_change": 0.23,
                 "last_updated_at": 1770586070},
}


def _bodies(spark, rows):
    return spark.createDataFrame(rows, "collection_timestamp long, body string")


def test_decode_answer_lenient_and_strict(spark):
    partial = dict(ANSWER, cardano={"usd": 0.27, "brl": 1.4, "usd_24h_vol": 7e8, "last_updated_at": 1})  # no change
    bodies = _bodies(spark, [(100, json.dumps(ANSWER)), (200, json.dumps(partial)), (300, "{not json"), (400, None)])
    decoded = price_answer.decode(bodies)
    lenient = price_answer.answer_to_rows(decoded, "collection_timestamp").collect()
    strict = price_answer.answer_to_rows(decoded, "collection_timestamp", strict=True).collect()
    assert sorted((r.collection_timestamp, r.crypto_id) for r in lenient) == [
        (100, "bitcoin"), (100, "ethereum"), (200, "bitcoin"), (200, "cardano"), (200, "ethereum")]
    assert sorted((r.collection_timestamp, r.crypto_id) for r in strict) == [(100, "bitcoin"), (100, "ethereum")]
    btc = [r for r in strict if r.crypto_id == "bitcoin"][0]
    assert btc.price_usd == 70956.0 and btc.volume_24h_usd == 40022567994.55898
    assert btc.collected_at == 100 and btc.last_updated_at == 1770586071
    assert [r.collection_timestamp for r in price_answer.undecodable(decoded).collect()] == [300]


def test_missing_and_extra_keys_and_counts(spark):
    keys = ("bitcoin", "ethereum", "cardano")
    rows = [tick(100, "bitcoin"), tick(100, "dogecoin"), tick(200, "bitcoin"), tick(200, "ethereum"),
            tick(200, "cardano")]
    df = ticks_df(spark, rows)
    cov = {r.collection: r for r in flatten.collection_coverage(df, keys).collect()}
    assert (cov[100].success_count, cov[100].failure_count, cov[100].missing_count) == (2, 1, 2)
    assert (cov[200].success_count, cov[200].failure_count, cov[200].missing_count) == (3, 0, 0)
    miss = sorted((r.collection, r.error) for r in flatten.missing_keys(df, keys).collect())
    assert miss == [(100, "Missing data for crypto: cardano"), (100, "Missing data for crypto: ethereum")]


def _answers(spark, rows):
    from tickwatch.sources import price_answer

    return price_answer.decode(spark.createDataFrame(rows, "collection_timestamp long, body string"))


QUOTE = '{"usd": 1.0, "brl": 5.0, "usd_24h_vol": 9.0, "usd_24h_change": 0.5, "last_updated_at": 40}'


def test_every_answer_gives_one_envelope(spark):
    from tickwatch.sources import price_answer

    keys = ("bitcoin", "ethereum")
    rows = [(100, f'{{"bitcoin": {QUOTE}}}'), (100, f'{{"ethereum": {QUOTE}}}'), (200, '{"bitcoin": {"usd": 1.0}}'),
            (300, '{"bitcoin": '), (400, "{}"), (500, None), (None, f'{{"bitcoin": {QUOTE}, "extra": {QUOTE}}}')]
    env = flatten.envelopes_from_answers(_answers(spark, rows), expected_keys=keys, error=price_answer.decode_error())
    got = [(r.metadata.collectionTimestamp, r.metadata.successCount, r.metadata.failureCount, tuple(r.metadata.errors), len(r.data))
           for r in env.collect()]
    missing = "Missing data for crypto: "
    assert sorted(got, key=repr) == sorted([
        (100, 1, 1, (missing + "ethereum",), 1), (100, 1, 1, (missing + "bitcoin",), 1),
        (200, 0, 2, (price_answer.INCOMPLETE,), 0), (300, 0, 2, (price_answer.NOT_JSON,), 0),
        (400, 0, 2, (missing + "bitcoin", missing + "ethereum"), 0), (500, 0, 2, (price_answer.NOT_JSON,), 0),
        (None, 2, 0, (missing + "ethereum",), 2)], key=repr)
    lenient = flatten.envelopes_from_answers(_answers(spark, rows), expected_keys=keys, error=price_answer.decode_error(strict=False))
    assert [len(r.data) for r in lenient.where("metadata.collectionTimestamp = 200").collect()] == [1]


def test_large_answer_is_one_envelope_without_a_shuffle(spark):
    body = "{" + ", ".join(f'"k{i}": {QUOTE}' for i in range(25_000)) + "}"
    env = flatten.envelopes_from_answers(_answers(spark, [(100, body)]))
    r = env.first()
    assert len(r.data) == r.metadata.successCount == 25_000 and r.metadata.failureCount == 5 - 25_000
    assert "Exchange" not in env._jdf.queryExecution().executedPlan().toString()


_tick_rows = st.lists(
    st.tuples(
        st.integers(min_value=1_600_000_000, max_value=1_600_010_000),
        st.sampled_from(["bitcoin", "ethereum", "solana", None]),
        st.one_of(st.none(), st.floats(min_value=-10, max_value=1e6, allow_nan=False)),
        st.floats(min_value=0, max_value=1e9, allow_nan=False),
    ),
    min_size=0,
    max_size=30,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_tick_rows)
def test_envelope_roundtrip_is_identity(spark, rows):
    df = ticks_df(spark, [tick(ts, k, price=p, volume=v) for ts, k, p, v in rows])
    back = flatten.explode_and_flatten(flatten.envelopes_from_ticks(df))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_landing_layout_and_read_back_with_pruning(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    # 2026-02-08 18:27:52 UTC and the next day 00:03:00
    rows = [tick(1770575272, "bitcoin"), tick(1770575272, "ethereum"), tick(1770595380, "bitcoin", price=None)]
    df = ticks_df(spark, rows)
    key = landing_key(df).select("object_key").distinct().orderBy("object_key").collect()
    assert [r.object_key for r in key] == [
        "year=2026/month=02/day=08/hour=18/crypto_prices_20260208_182752.json",
        "year=2026/month=02/day=09/hour=00/crypto_prices_20260209_000300.json",
    ]
    envelopes.land_envelopes(flatten.envelopes_from_ticks(df), root)
    assert os.path.isdir(os.path.join(root, "year=2026", "month=02", "day=08", "hour=18"))
    back = flatten.explode_and_flatten(envelopes.read_envelopes(spark, root))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    day = envelopes.read_envelopes(spark, root, where=(F.col("day") == "09"))
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().executedPlan().toString()
    assert flatten.explode_and_flatten(day).count() == 1
    pruned = envelopes.read_envelopes(spark, root, where=envelopes.partition_range(1770573600, 1770577199))
    assert flatten.explode_and_flatten(pruned).count() == 2


def test_quarantine_and_pretty_printed(spark, tmp_dir):
    good = {"metadata": {"collectionTimestamp": 5, "totalCryptos": 1, "successCount": 1, "failureCount": 0,
                         "errors": []},
            "data": [{"cryptoId": "bitcoin", "usd": 1.0, "brl": 2.0, "usd24hVol": 3.0, "usd24hChange": 4.0,
                      "lastUpdatedAt": 1, "collectedAt": 5}]}
    d = os.path.join(tmp_dir, "raw", "year=2026", "month=01", "day=01", "hour=00")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write(json.dumps(good) + "\n" + "{broken line\n")
    root = os.path.join(tmp_dir, "raw")
    assert envelopes.read_envelopes(spark, root).count() == 1
    q = envelopes.quarantine(spark, root).collect()
    assert [r.raw_line for r in q] == ["{broken line"] and q[0].year == "2026"
    pretty_root = os.path.join(tmp_dir, "pretty")
    os.makedirs(pretty_root)
    with open(os.path.join(pretty_root, "p.json"), "w") as f:
        f.write(json.dumps(good, indent=2))
    rows = flatten.explode_and_flatten(envelopes.read_envelopes(spark, pretty_root, multiline=True)).collect()
    assert len(rows) == 1 and rows[0].crypto_id == "bitcoin"


def _anoms(spark, rows):
    return spark.createDataFrame(rows, ", ".join(
        f"{c} {t}" for c, t in zip(
            ["crypto_id", "anomaly_type", "severity", "detected_at", "current_price", "reference_value",
             "variation_pct", "description"],
            ["string", "string", "string", "long", "double", "double", "double", "string"])))


def test_anomaly_sink_is_idempotent_and_prunes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "anomalies")
    a = _anoms(spark, [("bitcoin", "price_variation", "low", 1704067200, 1.0, 0.0, 6.0, "x"),
                       ("bitcoin", "volume_spike", "high", 1704153600, 9.0, 1.0, 9.0, "y")])
    assert tables.save_anomalies(a, path)
    assert tables.save_anomalies(a, path)
    assert tables.read_anomalies(spark, path).count() == 2
    assert not tables.save_anomalies(a.limit(0), path)
    day = tables.read_anomalies(spark, path, dt.date(2024, 1, 2))
    assert [r.severity for r in day.collect()] == ["high"]
    assert "PartitionFilters: [isnotnull(detection_date" in day._jdf.queryExecution().executedPlan().toString()
    # Recompute mode: the 2024-01-02 anomaly moved to "low"; the old severity partition is emptied.
    moved = _anoms(spark, [("bitcoin", "volume_spike", "low", 1704153600, 9.0, 3.0, 3.0, "y")])
    tables.replace_anomaly_dates(moved, path, [dt.date(2024, 1, 2)])
    got = sorted((r.detection_date.isoformat(), r.severity) for r in tables.read_anomalies(spark, path).collect())
    assert got == [("2024-01-01", "low"), ("2024-01-02", "low")]


def test_metrics_sink_keeps_string_keys_and_replaces_dates(spark, tmp_dir):
    from tickwatch.plans import transform

    path = os.path.join(tmp_dir, "metrics")
    rows = [tick(1704067200 + i * 180, "123", seq=i) for i in range(5)] + [tick(1704153600, "btc", seq=9)]
    m = transform.metrics(ticks_df(spark, rows, with_seq=True)).drop("seq")
    tables.write_metrics(m, path)
    back = tables.read_metrics(spark, path)
    assert back.schema["crypto_id"].dataType.simpleString() == "string"
    assert sorted(r.crypto_id for r in back.select("crypto_id").distinct().collect()) == ["123", "btc"]
    assert back.columns == METRICS.fieldNames()
    # dates mode rewrites 2024-01-02 only
    tables.write_metrics(m.where(F.col("crypto_id") == "btc"), path, replace="dates")
    assert tables.read_metrics(spark, path).count() == 6


def test_retention_and_expiry(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 20), 2), (dt.date(2024, 2, 1), 3)],
                               "collection_date date, v int")
    kept = tables.retain(df, "2024-02-15", 30).collect()
    assert sorted(r.v for r in kept) == [2, 3]
    df.write.partitionBy("collection_date").parquet(path)
    expired = tables.expire_dates(spark, path, "collection_date", df.schema, dt.date(2024, 2, 15), 30)
    assert sorted(expired) == [dt.date(2024, 1, 1)]
    assert sorted(r.v for r in spark.read.schema(df.schema).parquet(path).collect()) == [2, 3]


def test_daily_layout(spark, tmp_dir):
    a = _anoms(spark, [("bitcoin", "price_variation", "low", 1770575272, 1.0, 0.0, 6.0, "x")])
    tables.write_daily(a, tmp_dir, "anomalies", "detected_at")
    assert os.path.isdir(os.path.join(tmp_dir, "anomalies", "year=2026", "month=02", "day=08"))


def test_run_log_csv_import_and_report(spark, tmp_dir):
    p = os.path.join(tmp_dir, "metrics.csv")
    with open(p, "w") as f:
        f.write("timestamp,pipeline_stage,cryptos_processed,records_processed,anomalies_detected,alerts_sent,"
                "execution_time_ms,success,error_message\n")
        f.write("2026-02-08 18:00:00,processing,5,100,3,3,1200,true,\n")
        f.write('2026-02-08 18:15:00,processing,5,abc,2,0,900,false,"bad, thing\nhappened"\n')
        f.write("2026-02-08 18:30:00,processing,5,0,0,0,100,true,\n")
    log = run_log.read_run_log_csv(spark, p, quoted_newlines=True)
    rows = log.orderBy("timestamp").collect()
    assert [r.records_processed for r in rows] == [100, 0, 0]
    assert rows[1].error_message == "bad, thing\nhappened" and rows[1].success is False
    rep = reports.run_report(log).first()
    assert (rep.total_runs, rep.successful_runs, rep.failed_runs, rep.success_rate_pct) == (3, 2, 1, 67)
    assert (rep.total_records, rep.total_anomalies, rep.anomaly_rate_pct, rep.note) == (100, 5, "5.00", None)
    text = reports.run_report_text(reports.run_report(log)).first().report
    assert "Success Rate:                67%" in text and "Anomaly Rate:                5.00%" in text
    empty = spark.createDataFrame([], RUN_LOG_STRINGS)
    e = reports.run_report(reports.parse_run_log(empty)).first()
    assert (e.total_runs, e.success_rate_pct, e.anomaly_rate_pct, e.note) == (0, 0, "0.00", "No metrics available yet.")
    assert reports.run_report_text(reports.run_report(reports.parse_run_log(empty))).first().report == (
        "No metrics available yet.")


def _found(spark, n=40):
    return spark.createDataFrame(
        [("k", "volume_spike", "low", 1704067200 + i * 3600, float(i), 1.0, 3.0, "d") for i in range(n)],
        "crypto_id string, anomaly_type string, severity string, detected_at long, current_price double, "
        "reference_value double, variation_pct double, description string")


def test_writers_at_the_same_time_store_once(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    path = os.path.join(tmp_dir, "anomalies")
    tables.save_anomalies(_found(spark, 3), path)
    batches = [_found(spark, 40), _found(spark, 40), _found(spark, 25), _found(spark, 50)]
    with ThreadPoolExecutor(4) as pool:
        assert all(pool.map(lambda b: tables.save_anomalies(b, path), batches))
    assert tables.read_anomalies(spark, path).count() == 50
    assert not os.path.exists(path + "-writer")


def test_a_claim_left_behind_is_moved_away(spark, tmp_dir, monkeypatch):
    import pytest
    from tickwatch.sources import files

    path = os.path.join(tmp_dir, "anomalies")
    open(path + "-writer", "w").close()
    with pytest.raises(TimeoutError), files.sole_writer(spark, path, wait=0.3):
        pass
    os.utime(path + "-writer", (1, 1))  # its driver died long ago
    assert tables.save_anomalies(_found(spark, 2), path)
    assert not os.path.exists(path + "-writer") and any("-left-" in x for x in os.listdir(tmp_dir))
    monkeypatch.setattr(files, "RENEWED", 0.05)
    with files.sole_writer(spark, path):
        os.utime(path + "-writer", (1, 1))
        import time
        time.sleep(0.5)
        assert os.stat(path + "-writer").st_mtime > 1000


def test_multi_line_run_log_is_read_in_several_tasks(spark, tmp_dir):
    from pyspark.sql import functions as F

    path = os.path.join(tmp_dir, "log-csv")
    texts = ["plain", 'a "quoted" word', "two\nlines", '\n"\n,",\n\n', "commas, only", None, "2026,x,1\n2026,y,2", 'ends with "\n"']
    rows = [(f"2026-02-08 18:{i // 60 % 60:02d}:{i % 60:02d}", "processing", 5, i, 1, 0, 10, i % 2 == 0, texts[i % len(texts)]) for i in range(400)]
    log = spark.createDataFrame(rows, "timestamp string, pipeline_stage string, cryptos_processed int, records_processed long, "
                                      "anomalies_detected long, alerts_sent int, execution_time_ms long, success boolean, error_message string")
    run_log.write_run_log_csv(log.coalesce(2), path)
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("300", "1111", before):
        spark.conf.set(key, size)
        try:
            back = run_log.read_run_log_csv(spark, path)
            got = sorted((r.records_processed, r.success, (r.error_message or "").strip()) for r in back.collect())
            tasks = spark.read.text(path).select(F.spark_partition_id().alias("p")).distinct().count()
        finally:
            spark.conf.set(key, before)
        assert got == sorted((r[3], r[7], (r[8] or "").strip()) for r in rows), size
        assert size == before or tasks > 10
    crlf = os.path.join(tmp_dir, "crlf.csv")
    with open(crlf, "w", newline="") as f:
        f.write(",".join(back.columns) + "\r\n" + '2026-02-08 18:00:00,processing,5,7,1,0,10,false,"x\r\ny"\r\n')
    (row,) = run_log.read_run_log_csv(spark, crlf).collect()
    assert row.records_processed == 7 and row.error_message.split() == ["x", "y"]
    assert run_log.read_run_log_csv(spark, crlf, quoted_newlines=False).count() >= 1


def test_run_log_append(spark, tmp_dir):
    path = os.path.join(tmp_dir, "runlog")
    for ok in (True, False):
        run_log.append_run(reports.run_record(spark, "processing", 0, 5, 10, 1, 1, ok, None if ok else "x"), path)
    log = run_log.read_run_log(spark, path)
    assert sorted(r.success for r in log.collect()) == [False, True]


def test_market_chart(spark):
    bodies = spark.createDataFrame([
        ("two", json.dumps({"prices": [[1770500000000, 70000.0], [1770503600000, 71000.0], [1770507200000, 69000.0],
                                       [1770510800000, 70500.0]],
                            "market_caps": [[1770500000000, 1.4e12]], "total_volumes": []})),
        ("one", json.dumps({"prices": [[1770500000000, 5.0]]})),
        ("none", json.dumps({"prices": []})),
    ], "chart_id string, body string")
    dec = market_chart.decode(bodies)
    sizes = {r.chart_id: (r.prices_points, r.market_caps_points, r.total_volumes_points)
             for r in market_chart.series_sizes(dec).collect()}
    assert sizes == {"two": (4, 1, 0), "one": (1, 0, 0), "none": (0, 0, 0)}
    pts = market_chart.points(dec)
    stats = {r.chart_id: r for r in market_chart.chart_stats(pts.where(F.col("series") == "prices")).collect()}
    assert stats["two"].min_value == 69000.0 and stats["two"].max_value == 71000.0
    assert abs(stats["two"].variation_pct - 2000 / 69000 * 100) < 1e-9
    assert stats["one"].variation_pct is None and "none" not in stats
    first = market_chart.first_points(dec).where(F.col("chart_id") == "two").orderBy("idx").collect()
    assert [r.price for r in first] == [70000.0, 71000.0, 69000.0]
    assert first[0].ts == dt.datetime(2026, 2, 7, 21, 33, 20)


def test_table_exists_fails_closed(spark, tmp_dir):
    import pytest

    assert not tables.table_exists(spark, os.path.join(tmp_dir, "none"))
    assert tables.table_exists(spark, tmp_dir)
    with pytest.raises(Exception):  # an unreadable store is not an absent table
        tables.table_exists(spark, "nosuchstore://bucket/table")
    df = spark.createDataFrame([("b", "volume_spike", "low", 86400, 1.0, 1.0, 1.0, "d")],
                               "crypto_id string, anomaly_type string, severity string, detected_at long, current_price double, "
                               "reference_value double, variation_pct double, description string")
    path = "file:" + os.path.join(tmp_dir, "anoms")
    assert tables.save_anomalies(df, path) and tables.save_anomalies(df, path)
    assert tables.read_anomalies(spark, path).count() == 1
    later = df.withColumn("current_price", F.lit(2.0))  # another reading of the same second
    tables.save_anomalies(later, path)
    assert tables.read_anomalies(spark, path).count() == 2


def test_daily_layout_rerun_replaces(spark, tmp_dir):
    df = spark.createDataFrame([(1, 86400), (2, 172800)], "v int, ts long")
    for _ in range(2):
        tables.write_daily(df, tmp_dir, "x", "ts")
    assert spark.read.parquet(os.path.join(tmp_dir, "x")).count() == 2
