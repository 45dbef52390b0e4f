"""P10, P11, S10, A9; A2-A6, A14, O3; the batch jobs."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import tick, ticks_df
from tickwatch.operators import alerts, detect, flatten
from tickwatch.plans import jobs, reports
from tickwatch.sources import envelopes, tables

COLS = ("crypto_id string, anomaly_type string, severity string, detected_at long, current_price double, "
        "reference_value double, variation_pct double, description string")


def _anoms(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_subject_marks(spark):
    a = _anoms(spark, [("bitcoin", "volume_spike", "high", 1, 1.0, 1.0, 1.0, "d"),
                       ("ethereum", "price_variation", "medium", 2, 1.0, 0.0, 1.0, "d"),
                       ("solana", "price_variation", "low", 3, 1.0, 0.0, 1.0, "d")])
    got = [r.subject for r in alerts.with_text(alerts.to_alerts(a)).orderBy("detected_at").collect()]
    assert got == ["HIGH Crypto Alert: BITCOIN - volume_spike", "MEDIUM Crypto Alert: ETHEREUM - price_variation",
                   "_ Crypto Alert: SOLANA - price_variation"]


def test_body_text_exact(spark):
    a = _anoms(spark, [("bitcoin", "volume_spike", "high", 1770575272, 40022567994.55898, 1.0e10, 4.0,
                        "Volume is 4.00x the 24h average")])
    al = alerts.to_alerts(a)
    assert "reference_value" not in al.columns
    msg = alerts.with_text(al).first().message
    rule = "═" * 55
    expected = "\n".join([
        "", rule, "CRYPTO ANOMALY ALERT", rule, "",
        "Cryptocurrency: BITCOIN",
        "Anomaly Type:   volume_spike",
        "Severity:       HIGH",
        "",
        "Current Price:  $4.002256799455898E10",
        "Variation:      4.0%",
        "",
        "Description:    Volume is 4.00x the 24h average",
        "",
        "Detected At:    2026-02-08 18:27:52 UTC",
        "", rule, "This is an automated alert from Crypto Anomaly Detection System", rule, "       ",
    ])
    assert msg == expected


def test_delivery_failure_mid_batch_does_not_stop_the_rest(spark):
    rows = [("k%d" % i, "price_variation", "low", i, 1.0, 0.0, 6.0, "d") for i in range(20)]
    text = alerts.with_text(alerts.to_alerts(_anoms(spark, rows))).repartition(3)

    def flaky(key, subject, message):
        if key.startswith("k7|") or key.startswith("k13|"):
            raise RuntimeError("publish failed")
        return "id-" + key

    res = alerts.deliver(text, flaky)
    t = alerts.tally(res).first()
    assert (t.succeeded, t.failed) == (18, 2)
    errs = sorted(r.alert_key for r in res.where(~F.col("ok")).collect())
    assert errs == ["k13|price_variation|13|1.0", "k7|price_variation|7|1.0"]


def test_two_readings_of_one_second_are_both_sent_once(spark, tmp_dir):
    out, sent = os.path.join(tmp_dir, "outbox"), os.path.join(tmp_dir, "sent")
    os.mkdir(sent)

    def send(key, subject, message):
        open(os.path.join(sent, f"{key.replace('/', '_')}-{os.urandom(4).hex()}"), "w").close()
        return "id"

    first = [("bitcoin", "volume_spike", "low", 1704067200, 10.5, 1.0, 3.0, "d")]
    second = [("bitcoin", "volume_spike", "low", 1704067200, 11.5, 1.0, 3.0, "d"),
              ("bitcoin", "volume_spike", "low", 1704153600, 11.5, 1.0, 3.0, "d")]
    runs = [tuple(alerts.tally(alerts.deliver_pending(_anoms(spark, rows), out, send)).first())
            for rows in (first, first, first + second, second, [])]
    assert runs == [(1, 0), (0, 0), (2, 0), (0, 0), (0, 0)]
    assert sorted(name.rsplit("-", 1)[0] for name in os.listdir(sent)) == [
        "bitcoin|volume_spike|1704067200|10.5", "bitcoin|volume_spike|1704067200|11.5", "bitcoin|volume_spike|1704153600|11.5"]
    assert sorted(os.listdir(out))[-2:] == ["detection_date=2024-01-01", "detection_date=2024-01-02"]


def test_the_outbox_is_read_by_the_dates_of_the_batch(spark, tmp_dir):
    import datetime as dt

    out = os.path.join(tmp_dir, "outbox")
    days = [("k", "volume_spike", "low", 1704067200 + i * 86400, 1.0, 1.0, 3.0, "d") for i in range(5)]
    alerts.deliver_pending(_anoms(spark, days), out)
    one = alerts.outbox(spark, out, [dt.date(2024, 1, 3)])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters: [" in plan and "detection_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert alerts.outbox(spark, out, [None]).count() == 0 and alerts.outbox(spark, out).count() == 5


def test_repeated_alerts_and_saves_stage_their_batch_without_texts(spark, tmp_dir, monkeypatch):
    """A cached partition is read whole, texts included: nothing is cached, and what is staged holds no text and is removed."""
    from tickwatch.session import checkpoint_root
    from tickwatch.sources import files, tables

    batch = _anoms(spark, [(f"k{i}", "volume_spike", "low", 1704067200 + i, 1.0, 0.0, 3.0, "d") for i in range(20)])
    cached, staged, paths = [], [], []
    monkeypatch.setattr(type(batch), "persist", lambda self, *a: cached.append(self.columns) or self)
    monkeypatch.setattr(files, "scratch_path", lambda s, name: paths.append(f"{checkpoint_root(s)}/{name}-{len(paths)}") or paths[-1])
    first = alerts.staged
    monkeypatch.setattr(alerts, "staged", lambda df, name: staged.append(df.columns) or first(df, name))
    out, table, told = (os.path.join(tmp_dir, x) for x in ("outbox", "anomalies", "told"))
    os.mkdir(told)

    def send(key, subject, message):
        open(os.path.join(told, f"{key}~{subject}~{message.count(chr(10))}".replace("/", "_")), "w").close()
        return "id"

    assert tuple(alerts.tally(alerts.deliver_pending(batch.limit(5), out, send)).first()) == (5, 0)
    assert tuple(alerts.tally(alerts.deliver_pending(batch, out, send)).first()) == (15, 0)
    assert tables.save_anomalies(batch, table) and tables.save_anomalies(batch, table)
    assert tables.read_anomalies(spark, table).count() == 20
    assert cached == [] and len(staged) == 1 and not {"message", "subject"} & set(staged[0])
    assert len(os.listdir(told)) == 20 and all("HIGH" not in x and "~_ Crypto Alert: K" in x and x.endswith("~19") for x in os.listdir(told))
    assert len(paths) == 3 and not any(os.path.exists(p.removeprefix("file:")) for p in paths)


def test_counts_latest_top(spark):
    rows = [tick(100, "b", price=1.0, seq=1), tick(200, "b", price=2.0, seq=2), tick(200, "b", price=3.0, seq=3),
            tick(50, "a", price=9.0, seq=4)]
    m = ticks_df(spark, rows, with_seq=True)
    assert [(r.crypto_id, r["count"]) for r in reports.records_per_key(m).collect()] == [("b", 3), ("a", 1)]
    lp = [(r.crypto_id, r.latest_timestamp, r.latest_price) for r in reports.latest_price(m).collect()]
    assert lp == [("a", 50, 9.0), ("b", 200, 3.0)]
    a = _anoms(spark, [(f"k{i % 3}", "volume_spike" if i % 2 else "price_variation", "low", i, 1.0, 0.0, 1.0, str(i))
                       for i in range(30)])
    top = reports.top_recent(a, 10)
    assert [r.description for r in top.collect()] == [str(i) for i in range(29, 19, -1)]
    assert top.columns == ["crypto_id", "anomaly_type", "severity", "description"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    by_type = {r.anomaly_type: r["count"] for r in reports.anomalies_by_type(a).collect()}
    assert by_type == {"volume_spike": 15, "price_variation": 15}


def test_window_aggregates(spark):
    rows = [tick(0, price=1.0), tick(899, price=3.0), tick(900, price=10.0)]
    out = reports.window_aggregates(ticks_df(spark, rows), 15).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.avg_price, r.readings) for r in out] == [(0, 900, 2.0, 2), (900, 1800, 10.0, 1)]


def test_collection_summary_and_rollup(spark):
    env = flatten.envelopes_from_ticks(ticks_df(spark, [tick(100, "bitcoin"), tick(150, "ethereum"), tick(200, "bitcoin")]))
    s = {r.collection_timestamp: r for r in reports.collection_summary(env).collect()}
    assert (s[100].success_count, s[100].failure_count, len(s[100].errors)) == (1, 4, 4)
    roll = reports.collection_rollup(env).first()
    assert (roll.collections, roll.collected, roll.rows_landed) == (3, 3, 3)


def test_observe_and_is_empty(spark):
    df, obs = reports.observed(spark.range(7), "r")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7
    assert reports.is_empty(spark.range(0)) and not reports.is_empty(spark.range(1))


def test_processing_alerting_monitoring_jobs(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    rows = []
    for i in range(30):
        rows.append(tick(1704067200 + i * 180, "bitcoin", price=100.0 + i, volume=10.0 if i != 20 else 100.0,
                         change=6.0 if i == 25 else 0.0))
    envelopes.land_envelopes(flatten.envelopes_from_ticks(ticks_df(spark, rows)), raw)
    mp, ap, lp = (os.path.join(tmp_dir, x) for x in ("metrics", "anomalies", "runlog"))
    sent = []

    res = jobs.processing_job(spark, raw, mp, ap, lp, send=lambda k, s, m: "ok")
    assert res.success and res.records == 30 and res.anomalies == 2 and res.alerts_sent == 2
    stored = tables.read_anomalies(spark, ap)
    assert sorted(r.anomaly_type for r in stored.collect()) == ["price_variation", "volume_spike"]
    # rerun over the same raw data: nothing stored twice
    again = jobs.processing_job(spark, raw, mp, ap, lp, send=lambda k, s, m: "ok")
    assert (again.alerts_sent, again.alerts_failed) == (0, 0)  # the outbox holds them
    assert tables.read_anomalies(spark, ap).count() == 2
    other = os.path.join(tmp_dir, "outbox")
    job = jobs.alerting_job(spark, ap, "2024-01-01", outbox_path=other)
    assert (job.first().succeeded, job.first().failed) == (2, 0)  # a second action sends nothing
    assert [r.detected_at for r in alerts.sent_alerts(spark, other).collect()] == [1704067200 + 25 * 180, 1704067200 + 20 * 180]
    assert tuple(jobs.alerting_job(spark, ap, "2024-01-01", outbox_path=other).first()) == (0, 0)
    dash = jobs.monitoring_report(spark, mp, ap, lp)
    rr = dash["run_report"].first()
    assert (rr.total_runs, rr.successful_runs, rr.total_records, rr.total_anomalies) == (2, 2, 60, 4)
    assert [r["count"] for r in dash["records_per_key"].collect()] == [30]
    assert dash["latest_price"].first().latest_price == 129.0
    assert sent == []


def test_processing_job_records_failure(spark, tmp_dir):
    lp = os.path.join(tmp_dir, "runlog")
    try:
        jobs.processing_job(spark, os.path.join(tmp_dir, "missing"), os.path.join(tmp_dir, "m"),
                            os.path.join(tmp_dir, "a"), lp)
    except Exception:
        pass
    from tickwatch.sources import run_log

    r = run_log.read_run_log(spark, lp).first()
    assert r.success is False and r.error_message


def test_text_lines(spark):
    counts = spark.createDataFrame([("bitcoin", 1234), ("eth", 5)], "crypto_id string, count long")
    assert [r.line for r in reports.records_per_key_lines(counts).collect()] == [
        "          bitcoin: 1,234 records", "              eth:     5 records"]
    latest = spark.createDataFrame([("bitcoin", 70956.0)], "crypto_id string, latest_price double")
    assert reports.latest_price_lines(latest).first().line == "          bitcoin: $70,956.00"
    types = spark.createDataFrame([("volume_spike", 3)], "anomaly_type string, count long")
    assert reports.count_lines(types, "anomaly_type").first().line == "          volume_spike:     3"
    ticks = ticks_df(spark, [tick(1, "bitcoin", price=70956.0, volume=40022567994.55898, change=2.09)])
    assert reports.collected_lines(ticks).first().line == (
        "        bitcoin: USD     70956.00 | Change   2.09% | Vol     40022567995")


def test_incremental_job_matches_full_recompute(spark, tmp_dir):
    from tickwatch.plans import transform

    raw = os.path.join(tmp_dir, "raw")
    t0 = 1704067200
    rows = [tick(t0 + i * 180, k, price=50.0 + (i % 9), volume=10.0 if i % 40 else 80.0, change=6.0 if i % 33 == 0 else 0.0)
            for i in range(600) for k in ("bitcoin", "solana")]
    envelopes.land_envelopes(flatten.envelopes_from_ticks(ticks_df(spark, rows)), raw)
    tp, mp, ap = (os.path.join(tmp_dir, x) for x in ("ticks", "metrics", "anoms"))
    cut = t0 + 400 * 180 - (t0 + 400 * 180) % 3600  # an hour boundary
    jobs.incremental_job(spark, raw, t0, cut - 1, tp, mp, ap)
    jobs.incremental_job(spark, raw, cut, t0 + 600 * 180, tp, mp, ap)
    full = {(r.crypto_id, r.collection_timestamp): r for r in transform.metrics(ticks_df(spark, rows)).collect()}
    inc = {(r.crypto_id, r.collection_timestamp): r for r in tables.read_metrics(spark, mp).collect()}
    assert full.keys() == inc.keys()
    assert all(abs(full[k].volume_ma_24h - inc[k].volume_ma_24h) < 1e-9 for k in full)
    assert tables.read_anomalies(spark, ap).count() == detect.detect_all(transform.metrics(ticks_df(spark, rows))).count()


def test_expire_raw_days(spark, tmp_dir):
    import datetime as dt

    raw = os.path.join(tmp_dir, "raw")
    rows = [tick(1704067200, "bitcoin"), tick(1706745600, "bitcoin")]  # 2024-01-01, 2024-02-01
    envelopes.land_envelopes(flatten.envelopes_from_ticks(ticks_df(spark, rows)), raw)
    assert envelopes.expire_raw(spark, raw, dt.date(2024, 2, 10), 30) == ["2024-01-01"]
    left = flatten.explode_and_flatten(envelopes.read_envelopes(spark, raw)).collect()
    assert [r.collection_timestamp for r in left] == [1706745600]


def test_ingestion_job_lands_answers_and_failed_fetches(spark, tmp_dir):
    import json

    raw = os.path.join(tmp_dir, "raw")
    good = {"bitcoin": {"usd": 70956.0, "brl": 370185.0, "usd_24h_vol": 4.0e10, "usd_24h_change": 2.09,
                        "last_updated_at": 1770586071},
            "ethereum": {"usd": 2110.0, "brl": 11000.0, "usd_24h_vol": 1.8e10, "usd_24h_change": 0.23,
                         "last_updated_at": 1770586070}}
    answers = spark.createDataFrame(
        [(1770586080, json.dumps(good), None), (1770586260, None, "HTTP 429 Too Many Requests")],
        "collection_timestamp long, body string, error string",
    )
    summary = {r.collection_timestamp: r for r in jobs.ingestion_job(answers, raw, error_col="error").collect()}
    ok = summary[1770586080]
    assert (ok.total_expected, ok.success_count, ok.failure_count, ok.rows_landed) == (5, 2, 3, 2)
    assert sorted(ok.errors) == ["Missing data for crypto: binancecoin", "Missing data for crypto: cardano",
                                 "Missing data for crypto: solana"]
    bad = summary[1770586260]
    assert (bad.success_count, bad.failure_count, bad.rows_landed, bad.errors) == (0, 5, 0, ["HTTP 429 Too Many Requests"])
    flat = flatten.explode_and_flatten(envelopes.read_envelopes(spark, raw)).collect()
    assert sorted(r.crypto_id for r in flat) == ["bitcoin", "ethereum"]
    assert os.path.isdir(os.path.join(raw, "year=2026", "month=02", "day=08", "hour=21"))


def test_daily_outputs(spark, tmp_dir):
    from tickwatch.plans import transform

    rows = [tick(1770575272 + i * 180, "bitcoin", change=7.0) for i in range(5)]
    m = transform.metrics(ticks_df(spark, rows))
    jobs.daily_outputs(m, detect.detect_all(m, sort=False), tmp_dir)
    for name in ("anomalies", "aggregated_metrics"):
        assert os.path.isdir(os.path.join(tmp_dir, name, "year=2026", "month=02", "day=08"))


def test_command_line_jobs(spark, tmp_dir, capsys):
    import json

    from tickwatch.__main__ import main

    answers = os.path.join(tmp_dir, "answers.json")
    with open(answers, "w") as f:
        for i in range(30):
            body = {"bitcoin": {"usd": 100.0 + i, "brl": 500.0, "usd_24h_vol": 10.0 if i != 20 else 90.0,
                                "usd_24h_change": 6.0 if i == 25 else 0.0, "last_updated_at": 1704067100 + i * 180}}
            f.write(json.dumps({"collection_timestamp": 1704067200 + i * 180, "body": json.dumps(body)}) + "\n")
        f.write(json.dumps({"collection_timestamp": 1704067200 + 31 * 180, "error": "HTTP 500"}) + "\n")
    raw, mp, ap, lp = (os.path.join(tmp_dir, x) for x in ("raw", "metrics", "anomalies", "runs"))
    assert main(["ingest", "--answers", answers, "--raw", raw]) == 0
    assert main(["process", "--raw", raw, "--metrics", mp, "--anomalies", ap, "--runs", lp, "--no-alerts"]) == 0
    out = capsys.readouterr().out
    res = json.loads(out.strip().splitlines()[-1])
    assert res["records"] == 30 and res["anomalies"] == 2 and res["success"]
    assert main(["alert", "--anomalies", ap, "--date", "2024-01-01"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"succeeded": 2, "failed": 0}
    assert main(["alert", "--anomalies", ap, "--date", "2024-01-01"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"succeeded": 0, "failed": 0}
    assert main(["monitor", "--metrics", mp, "--anomalies", ap, "--runs", lp]) == 0
    assert "--- run_report" in capsys.readouterr().out
    assert main(["expire", "--raw", raw, "--as-of", "2024-03-01", "--days", "30"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"expired_days": ["2024-01-01"]}


def test_delivery_runs_where_the_package_is_not_on_the_workers_path(tmp_dir):
    """Started from another directory, executors cannot import the package;
    delivery must still work (the task function carries the code)."""
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from tickwatch.operators import alerts
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([("k", "volume_spike", "low", 1, 1.0, 2.0, "d")],
    "crypto_id string, anomaly_type string, severity string, detected_at long, current_price double, "
    "variation_pct double, description string")
t = alerts.tally(alerts.deliver(alerts.with_text(df), alerts.outbox_send)).first()
print("TALLY", t.succeeded, t.failed)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "TALLY 1 0" in out.stdout, out.stderr[-2000:]
