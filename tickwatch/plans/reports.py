"""Summaries over metrics, anomalies and the run log (A1-A8, A10, A11, A14,
O2-O4, P13, P14).

Every report is a DataFrame; the text renderings are optional projections of
those DataFrames. Counts use partial (map-side) aggregation, so a hot key
costs one partial row per task, not a shuffle of its rows.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwatch.functions.columns import lenient_long, ratio
from tickwatch.schemas import RUN_LOG

# Run-report text.
NO_METRICS = "No metrics available yet."
REPORT_RULE = "═" * 55
REPORT_TITLE = "METRICS REPORT"
REPORT_LINES = (
    "Total Pipeline Runs:        %d",
    "Successful Runs:             %d",
    "Failed Runs:                 %d",
    "Success Rate:                %d%%",
    "Total Records Processed:     %d",
    "Total Anomalies Detected:    %d",
    "Anomaly Rate:                %s%%",
)


# --- A1 / A11 ---------------------------------------------------------------

def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A1 without extra scans: row count collected as a side effect of the
    next action on the returned DataFrame (``obs.get["rows"]``)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def stage_counts(flat: DataFrame, metrics: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A1 as a table ``(stage, rows)``: flat rows, valid rows and the rows
    meeting each detection rule. The metrics are aggregated once (``count_if``
    per rule) instead of once per stage."""

    def unpivot(df: DataFrame, names: list[str]) -> DataFrame:
        pairs = ", ".join(f"'{n}', `{n}`" for n in names)
        return df.selectExpr(f"stack({len(names)}, {pairs}) as (stage, rows)")

    a = flat.agg(F.count(F.lit(1)).alias("flat_rows"))
    b = metrics.agg(
        F.count(F.lit(1)).alias("valid_rows"), *[F.count_if(c).alias(n) for n, c in rules.items()]
    )
    return unpivot(a, ["flat_rows"]).unionByName(unpivot(b, ["valid_rows", *rules]))


def is_empty(df: DataFrame) -> bool:
    """Emptiness via a one-row probe, not a full count."""
    return df.isEmpty()


# --- A2-A5, O2 ----------------------------------------------------------------

def count_by(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of ``col``, most first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(col))


def records_per_key(metrics: DataFrame) -> DataFrame:
    """A2."""
    return count_by(metrics, "crypto_id")


def anomalies_by_type(anomalies: DataFrame) -> DataFrame:
    """A3."""
    return count_by(anomalies, "anomaly_type")


def anomalies_by_severity(anomalies: DataFrame) -> DataFrame:
    """A4."""
    return count_by(anomalies, "severity")


def anomalies_by_key(anomalies: DataFrame) -> DataFrame:
    """A5."""
    return count_by(anomalies, "crypto_id")


def total(df: DataFrame) -> DataFrame:
    """One row with the number of rows (the dashboard's totals)."""
    return df.agg(F.count(F.lit(1)).alias("total"))


# --- A6 ---------------------------------------------------------------------

def latest_price(metrics: DataFrame, tie_col: str = "seq") -> DataFrame:
    """Latest timestamp and the price of the latest row per key.

    ``max_by`` over ``(timestamp, tie-breaker)`` is deterministic and
    partially aggregated, unlike an unordered ``last``. Without the
    tie-breaking column the row's other columns decide, so file order never does.
    """
    others = [c for c in metrics.columns if c not in ("collection_timestamp", "crypto_id")]
    order: Column = F.struct("collection_timestamp", *([tie_col] if tie_col in metrics.columns else others))
    return (
        metrics.groupBy("crypto_id")
        .agg(
            F.max("collection_timestamp").alias("latest_timestamp"),
            F.max_by("price_usd", order).alias("latest_price"),
        )
        .orderBy("crypto_id")
    )


# --- O3 / P13 ---------------------------------------------------------------

RECENT_COLUMNS = ("crypto_id", "anomaly_type", "severity", "description")


def top_recent(anomalies: DataFrame, n: int = 10, columns: Sequence[str] = RECENT_COLUMNS) -> DataFrame:
    """O3 + P13: the ``n`` newest anomalies (a distributed top-k: each task
    keeps ``n`` rows, then one merge)."""
    order = [F.col("detected_at").desc(), F.col("crypto_id"), F.col("anomaly_type"), F.col("severity")]
    return anomalies.orderBy(*order).limit(n).select(*columns)


# --- A7 / S9 ----------------------------------------------------------------

def parse_run_log(text_rows: DataFrame) -> DataFrame:
    """S9's lenient parse of text fields: a non-numeric count becomes 0,
    ``success`` is the text ``true``."""
    return text_rows.select(
        F.col("timestamp"),
        F.col("pipeline_stage"),
        lenient_long("cryptos_processed").cast("int").alias("cryptos_processed"),
        lenient_long("records_processed").alias("records_processed"),
        lenient_long("anomalies_detected").alias("anomalies_detected"),
        lenient_long("alerts_sent").cast("int").alias("alerts_sent"),
        lenient_long("execution_time_ms").alias("execution_time_ms"),
        (F.trim(F.col("success")) == F.lit("true")).alias("success"),
        F.nullif(F.col("error_message"), F.lit("")).alias("error_message"),
    )


def run_report(run_log: DataFrame) -> DataFrame:
    """One row — runs, successes, failures, success % (whole, half up,
    0 with no runs), records, anomalies, anomaly % as text with two
    decimals (``0.00`` with no records), and the summary line used when the
    log is empty."""
    agg = run_log.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.coalesce(F.col("success"), F.lit(False))).alias("successful_runs"),
        F.coalesce(F.sum("records_processed"), F.lit(0)).cast("long").alias("total_records"),
        F.coalesce(F.sum("anomalies_detected"), F.lit(0)).cast("long").alias("total_anomalies"),
    )
    success_pct = F.floor(ratio(F.col("successful_runs").cast("double"), "total_runs") * 100 + F.lit(0.5))
    anomaly_pct = ratio(F.col("total_anomalies").cast("double"), "total_records") * 100
    return agg.select(
        "total_runs",
        "successful_runs",
        (F.col("total_runs") - F.col("successful_runs")).alias("failed_runs"),
        F.when(F.col("total_runs") > 0, success_pct).otherwise(F.lit(0)).cast("long").alias("success_rate_pct"),
        "total_records",
        "total_anomalies",
        F.when(F.col("total_records") > 0, F.format_string("%.2f", anomaly_pct))
        .otherwise(F.lit("0.00"))
        .alias("anomaly_rate_pct"),
        F.when(F.col("total_runs") == 0, F.lit(NO_METRICS)).alias("note"),
    )


def run_report_text(report: DataFrame) -> DataFrame:
    """The report as one text column (or the empty-log note)."""
    runs, ok, failed, rate, records, anomalies, anomaly_rate = REPORT_LINES
    lines = [
        F.lit(""), F.lit(REPORT_RULE), F.lit(REPORT_TITLE), F.lit(REPORT_RULE), F.lit(""),
        F.format_string(runs, "total_runs"),
        F.format_string(ok, "successful_runs"),
        F.format_string(failed, "failed_runs"),
        F.format_string(rate, "success_rate_pct"),
        F.lit(""),
        F.format_string(records, "total_records"),
        F.format_string(anomalies, "total_anomalies"),
        F.format_string(anomaly_rate, "anomaly_rate_pct"),
        F.lit(""), F.lit(REPORT_RULE), F.lit(" " * 7),
    ]
    return report.select(F.coalesce(F.col("note"), F.concat_ws("\n", *lines)).alias("report"))


def run_record(
    spark: SparkSession,
    stage: str,
    started_ms: int,
    keys_processed: int,
    records: int,
    anomalies: int,
    alerts_sent: int,
    success: bool,
    error: str | None = None,
) -> DataFrame:
    """A10: the one-row run-metrics record for the run log."""
    now = int(time.time() * 1000)
    row = (
        time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(now / 1000)),
        stage,
        int(keys_processed),
        int(records),
        int(anomalies),
        int(alerts_sent),
        now - int(started_ms),
        bool(success),
        error,
    )
    return spark.createDataFrame([row], RUN_LOG)


# --- A8 ---------------------------------------------------------------------

def collection_summary(envelopes: DataFrame) -> DataFrame:
    """A8 per envelope: expected, collected, failed, rows landed, errors."""
    m = F.col("metadata")
    return envelopes.select(
        m["collectionTimestamp"].alias("collection_timestamp"),
        m["totalCryptos"].alias("total_expected"),
        m["successCount"].alias("success_count"),
        m["failureCount"].alias("failure_count"),
        F.coalesce(F.size("data"), F.lit(0)).alias("rows_landed"),
        F.coalesce(m["errors"], F.array().cast("array<string>")).alias("errors"),
    )


def collection_rollup(envelopes: DataFrame) -> DataFrame:
    """A8 over many envelopes: one row of totals."""
    s = collection_summary(envelopes)
    return s.agg(
        F.count(F.lit(1)).alias("collections"),
        F.sum("total_expected").alias("expected"),
        F.sum("success_count").alias("collected"),
        F.sum("failure_count").alias("failed"),
        F.sum("rows_landed").alias("rows_landed"),
        F.sum(F.size("errors")).alias("errors"),
        F.count_if(F.col("success_count") == 0).alias("empty_collections"),
    )


# --- A14 --------------------------------------------------------------------

def window_aggregates(metrics: DataFrame, minutes: int = 15) -> DataFrame:
    """Per key and tumbling ``minutes`` window — price avg/min/max,
    volume sum, reading count (our choice of contents)."""
    w = F.window(F.timestamp_seconds("collection_timestamp"), f"{minutes} minutes")
    return (
        metrics.groupBy("crypto_id", w.alias("w"))
        .agg(
            F.avg("price_usd").alias("avg_price"),
            F.min("price_usd").alias("min_price"),
            F.max("price_usd").alias("max_price"),
            F.sum("volume_24h_usd").alias("sum_volume"),
            F.count(F.lit(1)).alias("readings"),
        )
        .select(
            "crypto_id",
            F.unix_seconds(F.col("w.start")).alias("window_start"),
            F.unix_seconds(F.col("w.end")).alias("window_end"),
            "avg_price", "min_price", "max_price", "sum_volume", "readings",
        )
    )


# --- P14: text lines ----------------------------------------------------------

# Line patterns of the text reports (Java format syntax, which
# ``format_string`` implements).
LINE_RECORDS_PER_KEY = "  %15s: %,5d records"
LINE_LATEST_PRICE = "  %15s: $%,.2f"
LINE_BY_TYPE = "  %20s: %5d"
LINE_BY_KEY_OR_SEVERITY = "  %15s: %5d"
LINE_RECENT = "  %15s | %15s | %8s | %s"
LINE_ALERT = "  %15s | %20s | %8s | %s"
LINE_COLLECTED = "%15s: USD %12.2f | Change %6.2f%% | Vol %15.0f"


def text_lines(df: DataFrame, pattern: str, *cols: str) -> DataFrame:
    """One formatted text line per row (``line``), computed in the
    executors; order is the input's order."""
    return df.select(F.format_string(pattern, *[F.col(c) for c in cols]).alias("line"))


def records_per_key_lines(counts: DataFrame) -> DataFrame:
    return text_lines(counts, LINE_RECORDS_PER_KEY, "crypto_id", "count")


def latest_price_lines(latest: DataFrame) -> DataFrame:
    return text_lines(latest, LINE_LATEST_PRICE, "crypto_id", "latest_price")


def count_lines(counts: DataFrame, col: str) -> DataFrame:
    pattern = LINE_BY_TYPE if col == "anomaly_type" else LINE_BY_KEY_OR_SEVERITY
    return text_lines(counts, pattern, col, "count")


def recent_lines(recent: DataFrame) -> DataFrame:
    return text_lines(recent, LINE_RECENT, *RECENT_COLUMNS)


def alert_lines(anomalies: DataFrame) -> DataFrame:
    """The list of alerts an alerting run sends."""
    return text_lines(anomalies, LINE_ALERT, *RECENT_COLUMNS)


def collected_lines(flat_ticks: DataFrame) -> DataFrame:
    """A8's per-row line of a collection summary."""
    return text_lines(flat_ticks, LINE_COLLECTED, "crypto_id", "price_usd", "change_24h_pct", "volume_24h_usd")
