"""The four batch jobs wired from the operators.

* :func:`ingestion_job` — landed API answers -> envelopes under the hourly layout.
* :func:`processing_job` — envelopes -> metrics table -> anomalies -> alerts,
  with a run-log record written even when a stage fails.
* :func:`alerting_job` — one day's stored anomalies -> alert delivery -> tally.
* :func:`monitoring_report` — the dashboard's summaries as DataFrames.

Actions happen only here (writes, the one-row probes and tallies). The
metrics table is written once and read back for detection, which also cuts
the lineage: a lost executor during detection re-reads parquet instead of
recomputing the windows.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.operators import alerts, detect, flatten
from tickwatch.plans import reports, transform
from tickwatch.sources import envelopes, price_answer, run_log, tables


@dataclass
class RunResult:
    records: int = 0
    anomalies: int = 0
    alerts_sent: int = 0
    alerts_failed: int = 0
    success: bool = False
    error: str | None = None
    counts: dict[str, int] = field(default_factory=dict)


def ingestion_job(
    answers: DataFrame,
    raw_root: str,
    body_col: str = "body",
    ts_col: str = "collection_timestamp",
    expected_keys: Sequence[str] = flatten.DEFAULT_KEYS,
    strict: bool = True,
    error_col: str | None = None,
) -> DataFrame:
    """Decode answers (S2), wrap each one into an envelope with coverage
    metadata (P1, P2, P4, P5) and land the envelopes (S3). A failed fetch
    (``error_col``) and an answer that cannot be decoded become empty
    envelopes with their error (P3), so every answer is landed. Returns the
    summary (A8) of this batch's envelopes as a lazy DataFrame."""
    decoded = price_answer.decode(answers, body_col)
    error = price_answer.decode_error(body_col, strict)
    if error_col is not None:
        error = F.coalesce(F.col(error_col).cast("string"), error)
    env = flatten.envelopes_from_answers(decoded, ts_col, expected_keys, error)
    envelopes.land_envelopes(env, raw_root)
    return reports.collection_summary(env)


def processing_job(
    spark: SparkSession,
    raw_root: str,
    metrics_path: str,
    anomalies_path: str,
    run_log_path: str | None = None,
    raw_filter: Column | None = None,
    send: alerts.Send | None = None,
    alert: bool = True,
    outbox_path: str | None = None,
    keys_configured: int = len(flatten.DEFAULT_KEYS),
    chunk_rows: int | None = 16_384,
) -> RunResult:
    """S1 -> P6 -> P7/W1-W3/P8 -> S4 -> (S6) -> D5 -> S5 (+J2) -> alerts -> S8.

    Alerts go out for anomalies that the outbox table (by default next to the
    anomaly table) does not hold as delivered, so a rerun alerts nothing
    again. ``send=None`` records them only; ``alert=False`` leaves them alone."""
    started = int(time.time() * 1000)
    result = RunResult()
    try:
        raw = envelopes.read_envelopes(spark, raw_root, where=raw_filter)
        flat = flatten.explode_and_flatten(raw)
        metrics, obs = reports.observed(transform.metrics(flat, chunk_rows=chunk_rows), "metrics")
        tables.write_metrics(metrics, metrics_path)
        result.records = int(obs.get.get("rows", 0))
        stored = tables.read_metrics(spark, metrics_path)
        # A filter and a projection of the stored metrics: the count, the sink
        # and the alerts each read them, in splits of bounded size.
        found = detect.detect_all(stored, sort=False)
        result.anomalies = found.count()
        tables.save_anomalies(found, anomalies_path)
        if alert and result.anomalies:
            attempts = alerts.deliver_pending(found, outbox_path or default_outbox(anomalies_path), send)
            row = alerts.tally(attempts).first()
            result.alerts_sent, result.alerts_failed = int(row["succeeded"]), int(row["failed"])
        result.success = True
    except Exception as exc:  # noqa: BLE001 - recorded, then re-raised
        result.error = f"{type(exc).__name__}: {exc}"
        raise
    finally:
        if run_log_path is not None:
            rec = reports.run_record(
                spark, "processing", started, keys_configured, result.records, result.anomalies,
                result.alerts_sent, result.success, result.error,
            )
            run_log.append_run(rec, run_log_path)
    return result


def default_outbox(anomalies_path: str) -> str:
    return anomalies_path.rstrip("/") + "-outbox"


def alerting_job(
    spark: SparkSession,
    anomalies_path: str,
    on_date: Column | str | None = None,
    send: alerts.Send | None = None,
    outbox_path: str | None = None,
) -> DataFrame:
    """S7 (today's partition, pruned) -> P10 -> P11 -> S10 -> A9: delivers the
    day's pending alerts newest first and returns the one-row tally of this
    run, read from the outbox table. :func:`tickwatch.operators.alerts.sent_alerts` lists them."""
    day = tables.read_anomalies(spark, anomalies_path, on_date if on_date is not None else F.current_date())
    return alerts.tally(alerts.deliver_pending(day, outbox_path or default_outbox(anomalies_path), send))


def monitoring_report(
    spark: SparkSession,
    metrics_path: str | None = None,
    anomalies_path: str | None = None,
    run_log_path: str | None = None,
) -> dict[str, DataFrame]:
    """The dashboard as DataFrames; a missing table just leaves its entries
    out, any other failure is raised."""
    there = lambda path: path is not None and tables.table_exists(spark, path)
    out: dict[str, DataFrame] = {}
    if there(run_log_path):
        out["run_report"] = reports.run_report(run_log.read_run_log(spark, run_log_path))
    if there(metrics_path):
        m = tables.read_metrics(spark, metrics_path)
        out["records_per_key"] = reports.records_per_key(m)
        out["latest_price"] = reports.latest_price(m)
        out["total_records"] = reports.total(m)
    if there(anomalies_path):
        a = tables.read_anomalies(spark, anomalies_path)
        out["anomalies_by_type"] = reports.anomalies_by_type(a)
        out["anomalies_by_severity"] = reports.anomalies_by_severity(a)
        out["anomalies_by_key"] = reports.anomalies_by_key(a)
        out["top_recent"] = reports.top_recent(a)
        out["total_anomalies"] = reports.total(a)
    return out


def incremental_job(
    spark: SparkSession,
    raw_root: str,
    start_ts: int,
    end_ts: int,
    ticks_path: str,
    metrics_path: str,
    anomalies_path: str,
    chunk_rows: int | None = 16_384,
) -> None:
    """Process only the raw hours ``[start_ts, end_ts]`` (epoch seconds;
    directory pruning): the new flat ticks are stored, the moving averages
    use the last stored ticks of every key as context, and only the new rows' metrics and anomalies are written (anomalies
    idempotently). Same code path as the streaming sink (ST3)."""
    from tickwatch.operators.timecols import add_time_columns
    from tickwatch.streaming.ingest import rolling_metrics_sink

    raw = envelopes.read_envelopes(spark, raw_root, where=envelopes.partition_range(start_ts, end_ts))
    flat = add_time_columns(flatten.explode_and_flatten(raw))
    rolling_metrics_sink(ticks_path, metrics_path, anomalies_path, chunk_rows=chunk_rows)(flat, 0)


def daily_outputs(metrics: DataFrame, anomalies: DataFrame, root: str, window_minutes: int = 15) -> None:
    """The documented daily layout — ``anomalies`` and
    ``aggregated_metrics`` (A14's windowed aggregates) under
    ``<root>/<name>/year=/month=/day=``."""
    tables.write_daily(anomalies, root, "anomalies", "detected_at")
    tables.write_daily(reports.window_aggregates(metrics, window_minutes), root, "aggregated_metrics", "window_start")
