"""Registered check queries: each Spark query over the generated tables has a
DuckDB SQL twin that computes the same result the plain way.

Every query reads whole tables (``events`` through the tick adapter of
:mod:`tickwatch.sources.testdata`, ``orders`` for the run log). Doubles that
come out of window averages or ratios are presented as
``round(x + 1e-9, 6)`` on both sides: the engines sum frames in different
orders, and averages of cent values sit exactly on rounding ties often
enough that plain rounding would flip on last-bit differences. Operators
themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwatch.operators import alerts as _alerts
from tickwatch.operators import detect
from tickwatch.operators import flatten as _flatten
from tickwatch.operators.rolling import add_time_frame_average
from tickwatch.operators.timecols import add_time_columns, landing_columns, landing_key
from tickwatch.operators.validity import filter_valid
from tickwatch.plans import reports, transform
from tickwatch.session import scratch_path
from tickwatch.sources import envelopes as _envelopes
from tickwatch.sources import price_answer, testdata
from tickwatch.sources import run_log as _run_log
from tickwatch.sources import tables as _tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def cmp_round(c: Column | str) -> Column:
    """Presentation rounding for cross-engine comparison (see module doc)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: cmp_round(c) for c in cols})


# ---------------------------------------------------------------------------
# Shared SQL building blocks (DuckDB dialect).

TICKS_CTE = """
ticks AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) AS collection_timestamp,
         event_type AS crypto_id,
         CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS DOUBLE)
              WHEN event_id % 97 = 0 THEN CAST(0.0 AS DOUBLE)
              ELSE value END AS price_usd,
         value * 5 AS price_brl,
         value AS volume_24h_usd,
         (value - 50) / 5 AS change_24h_pct,
         CAST(floor(epoch(ts)) AS BIGINT) - 60 AS last_updated_at,
         CAST(floor(epoch(ts)) AS BIGINT) AS collected_at,
         event_id AS seq
  FROM events
)"""

SEQ_ORDER = "collection_timestamp, seq"
# Without a tie-breaker column the pipeline orders equal timestamps by the
# remaining columns, ascending with nulls first (see rolling.order_columns).
ROW_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in ("collection_timestamp", "crypto_id", "price_usd", "price_brl", "volume_24h_usd",
              "change_24h_pct", "last_updated_at", "collected_at")
)


def averaged_cte(order: str = SEQ_ORDER) -> str:
    frame = f"OVER (PARTITION BY crypto_id ORDER BY {order} ROWS BETWEEN {{n}} PRECEDING AND CURRENT ROW)"
    return (
        TICKS_CTE
        + f""",
averaged AS (
  SELECT *,
         strftime(make_timestamp(collection_timestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS collection_datetime,
         CAST(make_timestamp(collection_timestamp * 1000000) AS DATE) AS collection_date,
         CAST(hour(make_timestamp(collection_timestamp * 1000000)) AS INTEGER) AS collection_hour,
         CAST(minute(make_timestamp(collection_timestamp * 1000000)) AS INTEGER) AS collection_minute,
         avg(price_usd) {frame.format(n=480)} AS price_ma_24h,
         avg(volume_24h_usd) {frame.format(n=480)} AS volume_ma_24h,
         avg(price_usd) {frame.format(n=5)} AS price_ma_15min
  FROM ticks
)"""
    )


def metrics_cte(order: str = SEQ_ORDER) -> str:
    return (
        averaged_cte(order)
        + """,
metrics AS (
  SELECT * FROM averaged
  WHERE price_usd > 0 AND volume_24h_usd > 0 AND crypto_id IS NOT NULL
)"""
    )


AVERAGED_CTE = averaged_cte()
METRICS_CTE = metrics_cte()

VOLUME_SPIKES_SQL = """
  SELECT crypto_id, 'volume_spike' AS anomaly_type,
         CASE WHEN volume_24h_usd / volume_ma_24h > 5 THEN 'high'
              WHEN volume_24h_usd / volume_ma_24h > 3.5 THEN 'medium' ELSE 'low' END AS severity,
         collection_timestamp AS detected_at,
         volume_24h_usd AS current_price,
         volume_ma_24h AS reference_value,
         volume_24h_usd / volume_ma_24h AS variation_pct,
         'Volume is ' || format('{:,.2f}', volume_24h_usd / volume_ma_24h) || 'x the 24h average' AS description
  FROM metrics
  WHERE volume_ma_24h IS NOT NULL AND volume_ma_24h > 0 AND volume_24h_usd / volume_ma_24h > 2.5"""

PRICE_VARIATIONS_SQL = """
  SELECT crypto_id, 'price_variation' AS anomaly_type,
         CASE WHEN abs(change_24h_pct) > 15 THEN 'high'
              WHEN abs(change_24h_pct) > 10 THEN 'medium' ELSE 'low' END AS severity,
         collection_timestamp AS detected_at,
         price_usd AS current_price,
         CAST(0.0 AS DOUBLE) AS reference_value,
         change_24h_pct AS variation_pct,
         'Price changed ' || format('{:,.2f}', change_24h_pct) || '% in 24 hours' AS description
  FROM metrics
  WHERE abs(change_24h_pct) > 5.0"""

def anomalies_cte(order: str = SEQ_ORDER) -> str:
    return (
        metrics_cte(order)
        + f""",
anomalies AS (
{VOLUME_SPIKES_SQL}
  UNION ALL
{PRICE_VARIATIONS_SQL}
)"""
    )


ANOMALIES_CTE = anomalies_cte()

MA_COLS = ("price_ma_24h", "volume_ma_24h", "price_ma_15min")
_R = "round({0} + 1e-9, 6) AS {0}"


def _sql_round(*cols: str) -> str:
    return ", ".join(_R.format(c) for c in cols)


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return transform.metrics(testdata.ticks(spark, sf))


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    """Valid rows with time columns, for what needs no averages."""
    return filter_valid(add_time_columns(testdata.ticks(spark, sf)))


def _anomalies(spark: SparkSession, sf: str, sort: bool = False) -> DataFrame:
    return detect.detect_all(_metrics(spark, sf), sort=sort)


# ---------------------------------------------------------------------------
# Transform: P7, W1-W3, P8.


@register(
    "time_columns",
    f"""WITH {TICKS_CTE}
SELECT crypto_id, seq, collection_timestamp,
       strftime(make_timestamp(collection_timestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS collection_datetime,
       CAST(make_timestamp(collection_timestamp * 1000000) AS DATE) AS collection_date,
       CAST(hour(make_timestamp(collection_timestamp * 1000000)) AS INTEGER) AS collection_hour,
       CAST(minute(make_timestamp(collection_timestamp * 1000000)) AS INTEGER) AS collection_minute
FROM ticks""",
)
def q_time_columns(spark: SparkSession, sf: str) -> DataFrame:
    return add_time_columns(testdata.ticks(spark, sf)).select(
        "crypto_id", "seq", "collection_timestamp",
        "collection_datetime", "collection_date", "collection_hour", "collection_minute",
    )


@register(
    "moving_averages",
    f"""WITH {AVERAGED_CTE}
SELECT crypto_id, seq, collection_timestamp, {_sql_round(*MA_COLS)}
FROM averaged""",
)
def q_moving_averages(spark: SparkSession, sf: str) -> DataFrame:
    out = transform.with_averages(testdata.ticks(spark, sf))
    return rounded(out.select("crypto_id", "seq", "collection_timestamp", *MA_COLS), *MA_COLS)


@register(
    "valid_rows",
    f"""WITH {METRICS_CTE}
SELECT * REPLACE ({_sql_round(*MA_COLS)}) FROM metrics""",
)
def q_valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_metrics(spark, sf), *MA_COLS)


# ---------------------------------------------------------------------------
# Detection: D1-D5.


@register(
    "volume_spikes",
    f"""WITH {METRICS_CTE}
SELECT * REPLACE ({_sql_round('reference_value', 'variation_pct')}) FROM ({VOLUME_SPIKES_SQL})""",
)
def q_volume_spikes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(detect.detect_volume_spikes(_metrics(spark, sf)), "reference_value", "variation_pct")


@register(
    "price_variations",
    f"""WITH {METRICS_CTE}
{PRICE_VARIATIONS_SQL}""",
)
def q_price_variations(spark: SparkSession, sf: str) -> DataFrame:
    return detect.detect_price_variations(_valid(spark, sf))


@register(
    "all_anomalies",
    f"""WITH {ANOMALIES_CTE}
SELECT * REPLACE ({_sql_round('reference_value', 'variation_pct')}) FROM anomalies
ORDER BY detected_at DESC, crypto_id, anomaly_type""",
)
def q_all_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_anomalies(spark, sf, sort=True), "reference_value", "variation_pct")


# ---------------------------------------------------------------------------
# Envelopes and ingestion: P2, P3, P5, P6, A8, P4, J1, S2, P1, P9.


TICK_COLS = (
    "collection_timestamp, crypto_id, price_usd, price_brl, volume_24h_usd, "
    "change_24h_pct, last_updated_at, collected_at"
)
KEYS_SQL = "['click', 'error', 'purchase', 'signup', 'view']"
HOUR = "(collection_timestamp // 3600) * 3600"


def _hour_col() -> Column:
    return F.expr("(collection_timestamp div 3600) * 3600")


@register("envelope_flatten", f"WITH {TICKS_CTE} SELECT {TICK_COLS} FROM ticks")
def q_envelope_flatten(spark: SparkSession, sf: str) -> DataFrame:
    ticks = _flatten.ticks_only(testdata.ticks(spark, sf)).drop("seq")
    envelopes = _flatten.envelopes_from_ticks(ticks, testdata.EVENT_KEYS)
    return _flatten.explode_and_flatten(envelopes)


ANSWERS_SQL = f"""WITH {TICKS_CTE},
quotes AS (
  SELECT seq // 5 AS answer_id, min(collection_timestamp) OVER (PARTITION BY seq // 5) AS collection_timestamp, crypto_id, price_usd
  FROM ticks QUALIFY row_number() OVER (PARTITION BY seq // 5, crypto_id ORDER BY seq DESC) = 1),
answers AS (
  SELECT answer_id, min(collection_timestamp) AS collection_timestamp,
         answer_id % 13 = 0 OR (answer_id % 17 <> 0 AND count(price_usd) < count(*)) AS failed,
         CASE WHEN answer_id % 17 = 0 THEN 0 ELSE count(*) END AS keys
  FROM quotes GROUP BY answer_id),
counted AS (SELECT *, CASE WHEN failed THEN 0 ELSE keys END AS n FROM answers)
SELECT collection_timestamp, CAST(5 AS INTEGER) AS total_expected, CAST(n AS INTEGER) AS success_count,
       CAST(5 - n AS INTEGER) AS failure_count, CAST(n AS INTEGER) AS rows_landed,
       CAST(CASE WHEN failed THEN 1 ELSE 5 - n END AS INTEGER) AS n_errors
FROM counted"""


def _summary(summary: DataFrame) -> DataFrame:
    return summary.select(
        "collection_timestamp", "total_expected", "success_count", "failure_count", "rows_landed",
        F.size("errors").alias("n_errors"),
    )


@register("collection_summary", ANSWERS_SQL)
def q_collection_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One envelope per answer, failed answers included, with its counts and errors."""
    decoded = price_answer.decode(testdata.answers(spark, sf))
    return _summary(reports.collection_summary(_flatten.envelopes_from_answers(
        decoded, expected_keys=testdata.EVENT_KEYS, error=price_answer.decode_error())))


@register(
    "coverage",
    f"""WITH {TICKS_CTE}
SELECT {HOUR} AS collection,
       CAST(5 AS INTEGER) AS total_expected,
       CAST(count(DISTINCT crypto_id) AS INTEGER) AS success_count,
       CAST(5 - count(DISTINCT crypto_id) AS INTEGER) AS failure_count,
       CAST(5 - count(DISTINCT crypto_id) FILTER (WHERE crypto_id IN ('click', 'error', 'purchase', 'signup', 'view')) AS INTEGER) AS missing_count,
       count(*) AS rows_collected
FROM ticks GROUP BY 1""",
)
def q_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _flatten.collection_coverage(testdata.ticks(spark, sf), testdata.EVENT_KEYS, _hour_col())


@register(
    "missing_report",
    f"""WITH {TICKS_CTE},
hours AS (SELECT DISTINCT {HOUR} AS collection FROM ticks),
expected AS (SELECT unnest({KEYS_SQL}) AS crypto_id)
SELECT h.collection, e.crypto_id, 'Missing data for crypto: ' || e.crypto_id AS error
FROM hours h, expected e
WHERE NOT EXISTS (SELECT 1 FROM ticks t WHERE {HOUR.replace('collection_timestamp', 't.collection_timestamp')} = h.collection
                  AND t.crypto_id = e.crypto_id)""",
)
def q_missing_report(spark: SparkSession, sf: str) -> DataFrame:
    return _flatten.missing_keys(testdata.ticks(spark, sf), testdata.EVENT_KEYS, _hour_col())


@register("price_answer_decode", f"WITH {TICKS_CTE} SELECT {TICK_COLS} FROM ticks WHERE price_usd IS NOT NULL")
def q_price_answer_decode(spark: SparkSession, sf: str) -> DataFrame:
    bodies = price_answer.encode(testdata.ticks(spark, sf)).select("collection_timestamp", "body")
    decoded = price_answer.decode(bodies)
    return price_answer.answer_to_rows(decoded, "collection_timestamp", strict=True)


@register(
    "props_decode",
    """SELECT event_id, k AS key, CAST(json_extract(props, '$.' || k) AS DOUBLE) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
)
def q_props_decode(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T

    ev = testdata.table(spark, sf, "events").select("event_id", F.col("props").alias("body"))
    decoded = price_answer.decode(ev, value_type=T.DoubleType())
    return decoded.select("event_id", F.explode("answer").alias("key", "value"))


@register(
    "partition_cols",
    f"""WITH {TICKS_CTE}, p AS (
  SELECT crypto_id, seq, make_timestamp(collection_timestamp * 1000000) AS t FROM ticks)
SELECT crypto_id, seq,
       strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day, strftime(t, '%H') AS hour,
       'crypto_prices_' || strftime(t, '%Y%m%d_%H%M%S') || '.json' AS file_name,
       'year=' || strftime(t, '%Y') || '/month=' || strftime(t, '%m') || '/day=' || strftime(t, '%d')
         || '/hour=' || strftime(t, '%H') || '/crypto_prices_' || strftime(t, '%Y%m%d_%H%M%S') || '.json' AS object_key
FROM p""",
)
def q_partition_cols(spark: SparkSession, sf: str) -> DataFrame:
    keyed = landing_key(testdata.ticks(spark, sf))
    return keyed.select("crypto_id", "seq", "year", "month", "day", "hour", "file_name", "object_key")


# ---------------------------------------------------------------------------
# Documented rules: W4/D6, W5/D7, D8, W6, P12.


VALID_CTE = (
    TICKS_CTE
    + """,
valid AS (SELECT * FROM ticks WHERE price_usd > 0 AND volume_24h_usd > 0 AND crypto_id IS NOT NULL)"""
)


@register(
    "variation_15min",
    f"""WITH {VALID_CTE},
lagged AS (SELECT *, lag(price_usd, 5) OVER (PARTITION BY crypto_id ORDER BY collection_timestamp, seq) AS ref FROM valid),
pct AS (SELECT *, (price_usd - ref) / ref * 100 AS pct FROM lagged)
SELECT crypto_id, 'price_spike' AS anomaly_type,
       CASE WHEN abs(pct) > 20 THEN 'high' WHEN abs(pct) > 15 THEN 'medium' ELSE 'low' END AS severity,
       collection_timestamp AS detected_at, price_usd AS current_price, ref AS reference_value,
       round(pct + 1e-9, 6) AS variation_pct,
       'Price changed ' || format('{{:,.2f}}', pct) || '% over the last 5 readings' AS description
FROM pct WHERE abs(pct) > 10""",
)
def q_variation_15min(spark: SparkSession, sf: str) -> DataFrame:
    valid = filter_valid(testdata.ticks(spark, sf))
    return rounded(detect.detect_price_spikes(valid), "variation_pct")


@register(
    "pump_dump",
    f"""WITH {VALID_CTE},
framed AS (
  SELECT *, min(price_usd) OVER w AS lo, max(price_usd) OVER w AS hi FROM valid
  WINDOW w AS (PARTITION BY crypto_id ORDER BY collection_timestamp, seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
s AS (SELECT *, (hi - lo) / lo * 100 AS pump, (hi - price_usd) / hi * 100 AS dump FROM framed)
SELECT crypto_id, 'pump_dump' AS anomaly_type,
       CASE WHEN least(pump, dump) > 16 THEN 'high' WHEN least(pump, dump) > 12 THEN 'medium' ELSE 'low' END AS severity,
       collection_timestamp AS detected_at, price_usd AS current_price, hi AS reference_value,
       round(dump + 1e-9, 6) AS variation_pct,
       'Rose ' || format('{{:,.2f}}', pump) || '% then fell ' || format('{{:,.2f}}', dump) || '% within 10 readings' AS description
FROM s WHERE pump > 8 AND dump > 8""",
)
def q_pump_dump(spark: SparkSession, sf: str) -> DataFrame:
    valid = filter_valid(testdata.ticks(spark, sf))
    return rounded(detect.detect_pump_dump(valid), "variation_pct")


@register(
    "pump_dump_ordered",
    f"""WITH {VALID_CTE},
numbered AS (SELECT *, row_number() OVER (PARTITION BY crypto_id ORDER BY collection_timestamp, seq) AS rn FROM valid),
rises AS (
  SELECT r.crypto_id, r.rn, b.price_usd / a.price_usd AS rise, b.price_usd AS hi
  FROM numbered r JOIN numbered b ON b.crypto_id = r.crypto_id AND b.rn BETWEEN r.rn - 9 AND r.rn
  JOIN numbered a ON a.crypto_id = r.crypto_id AND a.rn BETWEEN r.rn - 9 AND b.rn
  QUALIFY row_number() OVER (PARTITION BY r.crypto_id, r.rn ORDER BY b.price_usd / a.price_usd DESC, b.price_usd DESC) = 1),
s AS (SELECT n.*, hi, (rise - 1) * 100 AS pump, (hi - price_usd) / hi * 100 AS dump FROM numbered n JOIN rises USING (crypto_id, rn))
SELECT crypto_id, 'pump_dump' AS anomaly_type,
       CASE WHEN least(pump, dump) > 16 THEN 'high' WHEN least(pump, dump) > 12 THEN 'medium' ELSE 'low' END AS severity,
       collection_timestamp AS detected_at, price_usd AS current_price, hi AS reference_value,
       round(dump + 1e-9, 6) AS variation_pct,
       'Rose ' || format('{{:,.2f}}', pump) || '% then fell ' || format('{{:,.2f}}', dump) || '% within 10 readings' AS description
FROM s WHERE pump > 8 AND dump > 8""",
)
def q_pump_dump_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Pump and dump whose minimum comes before its maximum."""
    valid = filter_valid(testdata.ticks(spark, sf))
    return rounded(detect.detect_pump_dump(valid, ordered=True), "variation_pct")


@register(
    "volume_spikes_spec",
    f"""WITH {TICKS_CTE},
av AS (SELECT *, avg(volume_24h_usd) OVER (PARTITION BY crypto_id ORDER BY collection_timestamp, seq
                                          ROWS BETWEEN 479 PRECEDING AND CURRENT ROW) AS vma FROM ticks),
m AS (SELECT *, volume_24h_usd / vma AS mult FROM av
      WHERE price_usd > 0 AND volume_24h_usd > 0 AND crypto_id IS NOT NULL AND vma IS NOT NULL AND vma > 0)
SELECT crypto_id, 'volume_spike' AS anomaly_type,
       CASE WHEN mult > 6 THEN 'high' WHEN mult > 4.5 THEN 'medium' ELSE 'low' END AS severity,
       collection_timestamp AS detected_at, volume_24h_usd AS current_price,
       round(vma + 1e-9, 6) AS reference_value, round(mult + 1e-9, 6) AS variation_pct,
       'Volume is ' || format('{{:,.2f}}', mult) || 'x the 24h average' AS description
FROM m WHERE mult > 3.0""",
)
def q_volume_spikes_spec(spark: SparkSession, sf: str) -> DataFrame:
    out = detect.detect_volume_spikes_spec(testdata.ticks(spark, sf))
    return rounded(out, "reference_value", "variation_pct")


@register(
    "time_frame_average",
    f"""WITH {TICKS_CTE}
SELECT crypto_id, seq, collection_timestamp,
       round(avg(price_usd) OVER (PARTITION BY crypto_id ORDER BY collection_timestamp
                                  RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) + 1e-9, 6) AS price_avg_24h_time
FROM ticks""",
)
def q_time_frame_average(spark: SparkSession, sf: str) -> DataFrame:
    out = add_time_frame_average(testdata.ticks(spark, sf), "price_usd", "price_avg_24h_time")
    return rounded(out.select("crypto_id", "seq", "collection_timestamp", "price_avg_24h_time"), "price_avg_24h_time")


@register(
    "anomaly_metrics",
    f"""WITH {ANOMALIES_CTE}
SELECT crypto_id, anomaly_type, detected_at, 'current_price' AS metric, round(current_price + 1e-9, 6) AS value FROM anomalies
UNION ALL
SELECT crypto_id, anomaly_type, detected_at, 'reference_value', round(reference_value + 1e-9, 6) FROM anomalies
UNION ALL
SELECT crypto_id, anomaly_type, detected_at, 'variation_pct', round(variation_pct + 1e-9, 6) FROM anomalies""",
)
def q_anomaly_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = detect.with_metrics_map(_anomalies(spark, sf))
    out = m.select("crypto_id", "anomaly_type", "detected_at", F.explode("metrics").alias("metric", "value"))
    return rounded(out, "value")


# ---------------------------------------------------------------------------
# Reports: A1-A6, O3/P13, A7/S9, A14, A12/A13, S12.


@register(
    "stage_counts",
    f"""WITH {ANOMALIES_CTE}
SELECT 'flat_rows' AS stage, count(*) AS rows FROM ticks
UNION ALL SELECT 'valid_rows', count(*) FROM metrics
UNION ALL SELECT 'volume_spikes', count(*) FROM anomalies WHERE anomaly_type = 'volume_spike'
UNION ALL SELECT 'price_variations', count(*) FROM anomalies WHERE anomaly_type = 'price_variation'""",
)
def q_stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    ticks = testdata.ticks(spark, sf)
    rules = {
        "volume_spikes": detect.volume_spike_rule()[0],
        "price_variations": detect.price_variation_rule()[0],
    }
    return reports.stage_counts(ticks, transform.metrics(ticks), rules)


@register("records_per_key", f"WITH {METRICS_CTE} SELECT crypto_id, count(*) AS count FROM metrics GROUP BY 1 ORDER BY 2 DESC, 1")
def q_records_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return reports.records_per_key(_valid(spark, sf))


@register("anomalies_by_type", f"WITH {ANOMALIES_CTE} SELECT anomaly_type, count(*) AS count FROM anomalies GROUP BY 1")
def q_anomalies_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return reports.anomalies_by_type(_anomalies(spark, sf))


@register("anomalies_by_severity", f"WITH {ANOMALIES_CTE} SELECT severity, count(*) AS count FROM anomalies GROUP BY 1")
def q_anomalies_by_severity(spark: SparkSession, sf: str) -> DataFrame:
    return reports.anomalies_by_severity(_anomalies(spark, sf))


@register("anomalies_by_key", f"WITH {ANOMALIES_CTE} SELECT crypto_id, count(*) AS count FROM anomalies GROUP BY 1")
def q_anomalies_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return reports.anomalies_by_key(_anomalies(spark, sf))


@register(
    "latest_price",
    f"""WITH {METRICS_CTE}
SELECT crypto_id, latest_timestamp, latest_price FROM (
  SELECT crypto_id, max(collection_timestamp) OVER (PARTITION BY crypto_id) AS latest_timestamp,
         price_usd AS latest_price,
         row_number() OVER (PARTITION BY crypto_id ORDER BY collection_timestamp DESC, seq DESC) AS rn
  FROM metrics) WHERE rn = 1""",
)
def q_latest_price(spark: SparkSession, sf: str) -> DataFrame:
    return reports.latest_price(_valid(spark, sf))


@register(
    "top10_recent",
    f"""WITH {ANOMALIES_CTE}
SELECT crypto_id, anomaly_type, severity, description FROM anomalies
ORDER BY detected_at DESC, crypto_id, anomaly_type, severity LIMIT 10""",
)
def q_top10_recent(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_recent(_anomalies(spark, sf), 10)


RUNS_CTE = """
runs AS (SELECT o_custkey AS records, floor(o_totalprice) AS anomalies, o_orderstatus <> 'P' AS success FROM orders)"""


@register(
    "run_report",
    f"""WITH {RUNS_CTE}
SELECT count(*) AS total_runs,
       count_if(success) AS successful_runs,
       count(*) - count_if(success) AS failed_runs,
       CASE WHEN count(*) > 0 THEN CAST(floor(count_if(success) / count(*) * 100 + 0.5) AS BIGINT) ELSE 0 END AS success_rate_pct,
       CAST(coalesce(sum(records), 0) AS BIGINT) AS total_records,
       CAST(coalesce(sum(anomalies), 0) AS BIGINT) AS total_anomalies,
       CASE WHEN coalesce(sum(records), 0) > 0
            THEN CAST(CAST(round(CAST(CAST(sum(anomalies) / sum(records) * 100 AS VARCHAR) AS DECIMAL(38, 12)), 2)
                           AS DECIMAL(38, 2)) AS VARCHAR)
            ELSE '0.00' END AS anomaly_rate_pct,
       CASE WHEN count(*) = 0 THEN 'No metrics available yet.' END AS note
FROM runs""",
)
def q_run_report(spark: SparkSession, sf: str) -> DataFrame:
    text = testdata.run_log_text_from_orders(testdata.table(spark, sf, "orders"))
    return reports.run_report(reports.parse_run_log(text))


@register(
    "window_15min",
    f"""WITH {METRICS_CTE}
SELECT crypto_id, (collection_timestamp // 900) * 900 AS window_start, (collection_timestamp // 900) * 900 + 900 AS window_end,
       round(avg(price_usd) + 1e-9, 6) AS avg_price, min(price_usd) AS min_price, max(price_usd) AS max_price,
       round(sum(volume_24h_usd) + 1e-9, 6) AS sum_volume, count(*) AS readings
FROM metrics GROUP BY ALL""",
)
def q_window_15min(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.window_aggregates(_valid(spark, sf), 15), "avg_price", "sum_volume")


@register(
    "chart_stats",
    f"""WITH {METRICS_CTE}
SELECT crypto_id || '@' || CAST({HOUR} AS VARCHAR) AS chart_id, count(*) AS points,
       min(price_usd) AS min_value, max(price_usd) AS max_value,
       CASE WHEN count(*) >= 2 THEN round((max(price_usd) - min(price_usd)) / min(price_usd) * 100 + 1e-9, 6) END AS variation_pct
FROM metrics GROUP BY 1""",
)
def q_chart_stats(spark: SparkSession, sf: str) -> DataFrame:
    from tickwatch.sources import market_chart

    pts = _valid(spark, sf).select(
        F.concat_ws("@", "crypto_id", _hour_col().cast("string")).alias("chart_id"), F.col("price_usd").alias("value")
    )
    return rounded(market_chart.chart_stats(pts), "variation_pct")


RETAIN_AS_OF = "2024-02-15"


@register(
    "retained",
    f"""WITH {METRICS_CTE}
SELECT crypto_id, seq, collection_date FROM metrics WHERE collection_date > DATE '{RETAIN_AS_OF}' - INTERVAL 30 DAY""",
)
def q_retained(spark: SparkSession, sf: str) -> DataFrame:
    from tickwatch.sources.tables import retain

    return retain(_valid(spark, sf), RETAIN_AS_OF, 30).select("crypto_id", "seq", "collection_date")


# ---------------------------------------------------------------------------
# Alerts: P10, P11a, P11b, S10, A9.


_RULE_SQL = "'" + _alerts.RULE + "'"


def _java_double_sql(x: str) -> str:
    # Doubles print like the JVM: plain decimal in [1e-3, 1e7), else d.dddE±n.
    return (
        f"CASE WHEN abs({x}) >= 1e-3 AND abs({x}) < 1e7 OR {x} = 0 THEN CAST({x} AS VARCHAR) "
        f"ELSE CAST({x} / pow(10, floor(log10(abs({x})))) AS VARCHAR) || 'E' || CAST(CAST(floor(log10(abs({x}))) AS BIGINT) AS VARCHAR) END"
    )


@register(
    "alert_subject",
    f"""WITH {ANOMALIES_CTE}
SELECT crypto_id || '|' || anomaly_type || '|' || CAST(detected_at AS VARCHAR) || '|' || ({_java_double_sql('current_price')}) AS alert_key,
       CASE severity WHEN 'high' THEN 'HIGH' WHEN 'medium' THEN 'MEDIUM' ELSE '_' END
         || ' Crypto Alert: ' || upper(crypto_id) || ' - ' || anomaly_type AS subject
FROM anomalies""",
)
def q_alert_subject(spark: SparkSession, sf: str) -> DataFrame:
    return _alerts.with_text(_alerts.to_alerts(_anomalies(spark, sf))).select("alert_key", "subject")


@register(
    "alert_body",
    f"""WITH {ANOMALIES_CTE},
a AS (SELECT crypto_id, anomaly_type, severity, description, detected_at,
             round(current_price + 1e-9, 6) AS cp, round(variation_pct + 1e-9, 6) AS vp FROM anomalies)
SELECT crypto_id || '|' || anomaly_type || '|' || CAST(detected_at AS VARCHAR) || '|' || ({_java_double_sql('cp')}) AS alert_key,
       concat_ws(chr(10), '', {_RULE_SQL}, 'CRYPTO ANOMALY ALERT', {_RULE_SQL}, '',
         'Cryptocurrency: ' || upper(crypto_id),
         'Anomaly Type:   ' || anomaly_type,
         'Severity:       ' || upper(severity),
         '',
         'Current Price:  $' || ({_java_double_sql('cp')}),
         'Variation:      ' || ({_java_double_sql('vp')}) || '%',
         '',
         'Description:    ' || description,
         '',
         'Detected At:    ' || strftime(make_timestamp(detected_at * 1000000), '%Y-%m-%d %H:%M:%S') || ' UTC',
         '', {_RULE_SQL}, 'This is an automated alert from Crypto Anomaly Detection System', {_RULE_SQL},
         '       ') AS message
FROM a""",
)
def q_alert_body(spark: SparkSession, sf: str) -> DataFrame:
    """Message text over alert numbers presented at 6 decimals (the engines
    differ in the last bits of the averages behind the multipliers)."""
    al = _alerts.to_alerts(_anomalies(spark, sf)).withColumns(
        {"current_price": cmp_round("current_price"), "variation_pct": cmp_round("variation_pct")}
    )
    return _alerts.with_text(al).select("alert_key", "message")


def _flaky_send(key: str, subject: str, message: str) -> str:
    """A sender that refuses every alert whose second is divisible by 7."""
    if int(key.split("|")[2]) % 7 == 0:
        raise RuntimeError("refused")
    return "sent-" + key


@register(
    "delivery_tally",
    f"""WITH {ANOMALIES_CTE}
SELECT count_if(detected_at % 7 <> 0) AS succeeded, count_if(detected_at % 7 = 0) AS failed FROM anomalies""",
)
def q_delivery_tally(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery through the outbox with a sender that fails for some alerts."""
    return _alerts.tally(_alerts.deliver_pending(_anomalies(spark, sf), scratch_path(spark, "outbox"), _flaky_send))


@register(
    "delivery_two_runs",
    f"""WITH {ANOMALIES_CTE},
a AS (SELECT *, row_number() OVER (PARTITION BY crypto_id, anomaly_type, detected_at ORDER BY current_price) = 1 AS early FROM anomalies)
SELECT 'first' AS run, count_if(detected_at % 7 <> 0) AS succeeded, count_if(detected_at % 7 = 0) AS failed FROM a WHERE early
UNION ALL SELECT 'second', count_if(detected_at % 7 <> 0 AND NOT early AND NOT exists(
    SELECT 1 FROM a b WHERE b.early AND b.crypto_id = a.crypto_id AND b.anomaly_type = a.anomaly_type
    AND b.detected_at = a.detected_at AND b.current_price = a.current_price)), count_if(detected_at % 7 = 0) FROM a""",
)
def q_delivery_two_runs(spark: SparkSession, sf: str) -> DataFrame:
    """One reading of every second is alerted, then all are. The second run
    sends the other readings of those seconds and tries the refused ones again."""
    path = scratch_path(spark, "outbox")
    every = _anomalies(spark, sf)
    rank = F.row_number().over(Window.partitionBy("crypto_id", "anomaly_type", "detected_at").orderBy("current_price"))
    early = every.withColumn("_r", rank).where("_r = 1").drop("_r")
    first, second = (_alerts.tally(_alerts.deliver_pending(found, path, _flaky_send)) for found in (early, every))
    return first.select(F.lit("first").alias("run"), "*").unionByName(second.select(F.lit("second").alias("run"), "*"))


# ---------------------------------------------------------------------------
# Sink round trips: S3/S1, S4/S6, S5/J2/S7, S8/S9, ST1. Each call writes under
# the session's checkpoint directory (shared storage on a cluster) and
# returns a DataFrame over what was written.


STORED_ANOMALIES_SQL = f"""WITH {ANOMALIES_CTE}
SELECT * REPLACE ({_sql_round('reference_value', 'variation_pct')}),
       CAST(make_timestamp(detected_at * 1000000) AS DATE) AS detection_date
FROM anomalies"""


@register("landing_roundtrip", f"WITH {TICKS_CTE} SELECT {TICK_COLS} FROM ticks")
def q_landing_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "raw")
    ticks = _flatten.ticks_only(testdata.ticks(spark, sf)).drop("seq")
    _envelopes.land_envelopes(_flatten.envelopes_from_ticks(ticks, testdata.EVENT_KEYS), root)
    return _flatten.explode_and_flatten(_envelopes.read_envelopes(spark, root))


@register(
    "metrics_table_roundtrip",
    f"""WITH {METRICS_CTE}
SELECT * EXCLUDE (seq) REPLACE ({_sql_round(*MA_COLS)}) FROM metrics""",
)
def q_metrics_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    _tables.write_metrics(_metrics(spark, sf), path)
    return rounded(_tables.read_metrics(spark, path), *MA_COLS)


@register("anomaly_sink_twice", STORED_ANOMALIES_SQL)
def q_anomaly_sink_twice(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "anomalies")
    found = _anomalies(spark, sf)
    _tables.save_anomalies(found, path)
    _tables.save_anomalies(found, path)  # a rerun: stores nothing new
    return rounded(_tables.read_anomalies(spark, path), "reference_value", "variation_pct")


ONE_DAY = "2024-01-15"


@register(
    "anomalies_one_day",
    f"""SELECT * FROM ({STORED_ANOMALIES_SQL}) WHERE detection_date = DATE '{ONE_DAY}'""",
)
def q_anomalies_one_day(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "anomalies")
    _tables.save_anomalies(_anomalies(spark, sf), path)
    return rounded(_tables.read_anomalies(spark, path, ONE_DAY), "reference_value", "variation_pct")


@register("run_log_csv_report", ORACLE_SQL["run_report"])
def q_run_log_csv_report(spark: SparkSession, sf: str) -> DataFrame:
    """The log as CSV, its error texts of two lines with quotes and commas."""
    path = scratch_path(spark, "runlog-csv")
    typed = reports.parse_run_log(testdata.run_log_text_from_orders(testdata.table(spark, sf, "orders")))
    texts = F.when(F.col("error_message").isNotNull(), F.concat("error_message", F.lit(':\n"line" two, 2026-01-01')))
    _run_log.write_run_log_csv(typed.withColumn("error_message", texts), path)
    return reports.run_report(_run_log.read_run_log_csv(spark, path))


@register("run_log_parquet_report", ORACLE_SQL["run_report"])
def q_run_log_parquet_report(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "runlog")
    typed = reports.parse_run_log(testdata.run_log_text_from_orders(testdata.table(spark, sf, "orders")))
    _run_log.append_run(typed, path)
    return reports.run_report(_run_log.read_run_log(spark, path))


@register("stream_ingest", f"WITH {TICKS_CTE} SELECT DISTINCT crypto_id, collection_timestamp FROM ticks")
def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """ST1 over envelopes landed from the events table: flat ticks deduplicated
    on (crypto_id, collection_timestamp) within the watermark. Which of two
    rows sharing that identity survives is not defined, so the identities are returned."""
    from tickwatch.streaming import ingest

    raw, out, ck = scratch_path(spark, "raw"), scratch_path(spark, "ticks"), scratch_path(spark, "ck")
    ticks = _flatten.ticks_only(testdata.ticks(spark, sf)).drop("seq")
    _envelopes.land_envelopes(_flatten.envelopes_from_ticks(ticks, testdata.EVENT_KEYS), raw)

    def sink(batch: DataFrame, batch_id: int) -> None:
        ingest.write_ticks(batch, out)

    ingest.start(ingest.stream_ticks(spark, raw, watermark="100 days"), sink, ck, available_now=True).awaitTermination()
    return spark.read.parquet(out).select("crypto_id", "collection_timestamp")


@register(
    "stream_side_outputs",
    f"""WITH {TICKS_CTE},
a AS (SELECT * FROM ticks WHERE seq % 10 <> 0),
b AS (SELECT *, collection_timestamp < (SELECT max(collection_timestamp) FROM a) - 3600 AS late FROM ticks WHERE seq % 10 = 0),
firsts AS (SELECT DISTINCT crypto_id, collection_timestamp FROM a),
onward AS (SELECT * FROM b WHERE NOT late),
fresh AS (SELECT DISTINCT crypto_id, collection_timestamp FROM onward
          EXCEPT SELECT crypto_id, collection_timestamp FROM firsts)
SELECT 'tick' AS outcome, (SELECT count(*) FROM firsts) + (SELECT count(*) FROM fresh) AS n
UNION ALL SELECT 'late', (SELECT count(*) FROM b WHERE late)
UNION ALL SELECT 'duplicate', (SELECT count(*) FROM a) - (SELECT count(*) FROM firsts)
                              + (SELECT count(*) FROM onward) - (SELECT count(*) FROM fresh)
UNION ALL SELECT 'malformed', (SELECT count(*) FROM ticks WHERE seq % 50 = 0)""",
)
def q_stream_side_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """ST1 at the default watermark: rows landed later and broken lines are in the side table, nothing is lost."""
    from tickwatch.streaming import ingest

    raw, out, side, ck = (scratch_path(spark, x) for x in ("raw", "ticks", "side", "ck"))
    every = testdata.ticks(spark, sf)
    for late in (False, True):
        rows = _flatten.ticks_only(every.where(F.col("seq") % 10 == 0 if late else F.col("seq") % 10 != 0)).drop("seq")
        _envelopes.land_envelopes(_flatten.envelopes_from_ticks(rows, testdata.EVENT_KEYS), raw)
        if late:
            broken = landing_columns(every.where("seq % 50 = 0"), "collection_timestamp").select(
                F.concat(F.lit('{"metadata": broken '), F.col("seq").cast("string")).alias("value"), *_envelopes.PARTITIONS)
            broken.write.mode("append").partitionBy(*_envelopes.PARTITIONS).text(raw)
        ingest.start(ingest.stream_landed(spark, raw), ingest.ingest_sink(out, side), ck, available_now=True).awaitTermination()
    outcomes = spark.read.parquet(out).select(F.lit("tick").alias("outcome")).unionByName(
        spark.read.parquet(side).select(F.col("reason").alias("outcome")))
    names = ("tick", "late", "duplicate", "malformed")
    counts = outcomes.agg(*[F.count_if(F.col("outcome") == n).alias(n) for n in names])
    return counts.unpivot([], list(names), "outcome", "n")


QUOTES_SQL = f"""WITH {TICKS_CTE},
placed AS (SELECT *, seq // 5 AS answer_id, min(collection_timestamp) OVER (PARTITION BY seq // 5) AS asked FROM ticks),
quotes AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY answer_id, crypto_id ORDER BY seq DESC) = 1)
SELECT asked AS collection_timestamp, crypto_id, price_usd, price_brl, volume_24h_usd, change_24h_pct, last_updated_at, asked AS collected_at
FROM quotes
WHERE answer_id % 13 <> 0 AND answer_id % 17 <> 0
  AND answer_id NOT IN (SELECT answer_id FROM quotes WHERE price_usd IS NULL)"""


def _answer_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    decoded = price_answer.decode(testdata.answers(spark, sf))
    return _flatten.envelopes_from_answers(decoded, expected_keys=testdata.EVENT_KEYS, error=price_answer.decode_error())


@register("answer_flatten", QUOTES_SQL)
def q_answer_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """P2 and P6 over envelopes of several keys, failed and empty ones among them."""
    return _flatten.explode_and_flatten(_answer_envelopes(spark, sf))


@register("answer_landing_roundtrip", QUOTES_SQL)
def q_answer_landing_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S3 and S1 with the same envelopes: landed as JSON lines and read back."""
    root = scratch_path(spark, "raw")
    _envelopes.land_envelopes(_answer_envelopes(spark, sf), root)
    return _flatten.explode_and_flatten(_envelopes.read_envelopes(spark, root))


@register(
    "run_record",
    f"""WITH {anomalies_cte(ROW_ORDER)}
SELECT 'processing' AS pipeline_stage, CAST(5 AS INTEGER) AS cryptos_processed, (SELECT count(*) FROM metrics) AS records_processed,
       (SELECT count(*) FROM anomalies) AS anomalies_detected, CAST((SELECT count(*) FROM anomalies) AS INTEGER) AS alerts_sent,
       true AS success, CAST(NULL AS VARCHAR) AS error_message, true AS timed
UNION ALL SELECT 'processing', 5, 0, 0, 0, false, 'missing', true""",
)
def q_run_record(spark: SparkSession, sf: str) -> DataFrame:
    """A10: the run records of one processing job that succeeds and of one whose input is not there."""
    from tickwatch.plans import jobs

    raw, metrics_path, anomalies_path, runs = (scratch_path(spark, x) for x in ("raw", "metrics", "anomalies", "runs"))
    ticks = _flatten.ticks_only(testdata.ticks(spark, sf)).drop("seq")
    _envelopes.land_envelopes(_flatten.envelopes_from_ticks(ticks, testdata.EVENT_KEYS), raw)
    jobs.processing_job(spark, raw, metrics_path, anomalies_path, runs, keys_configured=len(testdata.EVENT_KEYS))
    try:
        jobs.processing_job(spark, raw + "-missing", metrics_path + "-2", anomalies_path + "-2", runs, keys_configured=len(testdata.EVENT_KEYS))
    except Exception as exc:  # noqa: BLE001 - the record is what is asked for
        if "PATH_NOT_FOUND" not in str(exc):
            raise
    record = _run_log.read_run_log(spark, runs)
    return record.select(
        "pipeline_stage", "cryptos_processed", "records_processed", "anomalies_detected", "alerts_sent", "success",
        F.when(F.col("error_message").contains("PATH_NOT_FOUND"), "missing").otherwise(F.col("error_message")).alias("error_message"),
        ((F.col("execution_time_ms") >= 0) & F.to_timestamp("timestamp", "yyyy-MM-dd HH:mm:ss").isNotNull()).alias("timed"))


@register(
    "empty_probes",
    f"""WITH {VALID_CTE}
SELECT k AS crypto_id, NOT exists(SELECT 1 FROM valid WHERE crypto_id = k AND abs(change_24h_pct) > 9.9) AS nothing_found
FROM (SELECT unnest({KEYS_SQL[:-1]}, 'nokey']) AS k)""",
)
def q_empty_probes(spark: SparkSession, sf: str) -> DataFrame:
    """Is there anything to save for a key? A key that does not exist is asked about too."""
    found = detect.detect_price_variations(_valid(spark, sf), threshold=9.9)
    probes = [(k, reports.is_empty(found.where(F.col("crypto_id") == k))) for k in (*testdata.EVENT_KEYS, "nokey")]
    return spark.createDataFrame(probes, "crypto_id string, nothing_found boolean")


@register("ingestion_summary", ANSWERS_SQL)
def q_ingestion_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The ingestion job end to end: answers of several keys, some broken,
    incomplete or empty, are decoded strictly, wrapped one by one, landed under
    the hourly layout and read back; every answer has its envelope."""
    from tickwatch.plans import jobs

    raw = scratch_path(spark, "raw")
    jobs.ingestion_job(testdata.answers(spark, sf), raw, expected_keys=testdata.EVENT_KEYS)
    return _summary(reports.collection_summary(_envelopes.read_envelopes(spark, raw)))


@register(
    "processing_job_anomalies",
    f"""WITH {anomalies_cte(ROW_ORDER)}
SELECT * REPLACE ({_sql_round('reference_value', 'variation_pct')}),
       CAST(make_timestamp(detected_at * 1000000) AS DATE) AS detection_date
FROM anomalies""",
)
def q_processing_job_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """The processing job end to end over envelopes landed from the events
    table: scan, flatten, metrics written and read back, detection, the
    idempotent anomaly sink (run twice), alert delivery and the run log.
    Landing drops the tie-breaker column, so equal timestamps are ordered by
    the row's other columns, on both sides."""
    from tickwatch.plans import jobs

    raw, metrics_path, anomalies_path, runs = (
        scratch_path(spark, x) for x in ("raw", "metrics", "anomalies", "runs")
    )
    ticks = _flatten.ticks_only(testdata.ticks(spark, sf)).drop("seq")
    _envelopes.land_envelopes(_flatten.envelopes_from_ticks(ticks, testdata.EVENT_KEYS), raw)
    for _ in range(2):
        jobs.processing_job(spark, raw, metrics_path, anomalies_path, runs, keys_configured=len(testdata.EVENT_KEYS))
    return rounded(_tables.read_anomalies(spark, anomalies_path), "reference_value", "variation_pct")


@register(
    "alerting_job_tally",
    f"""WITH {ANOMALIES_CTE},
day AS (SELECT crypto_id, anomaly_type, detected_at FROM anomalies
        WHERE CAST(make_timestamp(detected_at * 1000000) AS DATE) = DATE '{ONE_DAY}')
SELECT 'first' AS run, count_if(detected_at % 7 <> 0) AS succeeded, count_if(detected_at % 7 = 0) AS failed FROM day
UNION ALL SELECT 'second', CAST(0 AS BIGINT), count_if(detected_at % 7 = 0) FROM day""",
)
def q_alerting_job_tally(spark: SparkSession, sf: str) -> DataFrame:
    """The alerting job twice over one detection date of the anomaly table:
    the second run tries only what the first could not deliver."""
    from tickwatch.plans import jobs

    path = scratch_path(spark, "anomalies")
    _tables.save_anomalies(_anomalies(spark, sf), path)
    first, second = (jobs.alerting_job(spark, path, ONE_DAY, _flaky_send) for _ in range(2))
    return first.select(F.lit("first").alias("run"), "*").unionByName(second.select(F.lit("second").alias("run"), "*"))


UNIQUE_TICKS_CTE = TICKS_CTE.replace("ticks AS (", "all_ticks AS (", 1) + """,
ticks AS (SELECT * FROM all_ticks QUALIFY row_number() OVER (PARTITION BY crypto_id, collection_timestamp ORDER BY seq DESC) = 1)"""


def _unique_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """The last tick of every (key, second), so that identities are unique."""
    ticks = testdata.ticks(spark, sf)
    rest = [c for c in ticks.columns if c not in ("crypto_id", "collection_timestamp")]
    last = ticks.groupBy("crypto_id", "collection_timestamp").agg(F.max_by(F.struct(*rest), "seq").alias("r"))
    return _flatten.ticks_only(last.select("crypto_id", "collection_timestamp", "r.*")).drop("seq")


@register(
    "stream_price_variations",
    f"""WITH {UNIQUE_TICKS_CTE},
metrics AS (SELECT * FROM ticks WHERE price_usd > 0 AND volume_24h_usd > 0 AND crypto_id IS NOT NULL)
SELECT crypto_id, detected_at, severity, current_price, variation_pct FROM ({PRICE_VARIATIONS_SQL})""",
)
def q_stream_price_variations(spark: SparkSession, sf: str) -> DataFrame:
    """ST2: landed envelopes, landed twice, streamed into the anomaly table."""
    from tickwatch.streaming import ingest

    raw, out, ck = scratch_path(spark, "raw"), scratch_path(spark, "anomalies"), scratch_path(spark, "ck")
    env = _flatten.envelopes_from_ticks(_unique_ticks(spark, sf), testdata.EVENT_KEYS)
    for _ in range(2):
        _envelopes.land_envelopes(env, raw)
    stream = ingest.stream_ticks(spark, raw, watermark="100 days")
    ingest.start(stream, ingest.price_variation_sink(out), ck, available_now=True).awaitTermination()
    return _tables.read_anomalies(spark, out).select("crypto_id", "detected_at", "severity", "current_price", "variation_pct")


@register(
    "incremental_metrics",
    f"""WITH {averaged_cte(ROW_ORDER)}
SELECT crypto_id, collection_timestamp, price_usd, {_sql_round('price_ma_24h', 'volume_ma_24h')} FROM averaged
WHERE price_usd > 0 AND volume_24h_usd > 0 AND crypto_id IS NOT NULL""",
)
def q_incremental_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """ST3: two increments give the batch result at the events' uneven cadence, two readings of one second included."""
    from tickwatch.plans import jobs

    ticks = _flatten.ticks_only(testdata.ticks(spark, sf)).drop("seq")
    raw, tp, mp, ap = (scratch_path(spark, x) for x in ("raw", "ticks", "metrics", "anomalies"))
    _envelopes.land_envelopes(_flatten.envelopes_from_ticks(ticks, testdata.EVENT_KEYS), raw)
    lo, hi = ticks.agg(F.min("collection_timestamp"), F.max("collection_timestamp")).first()
    cut = (lo + hi) // 2 // 3600 * 3600
    jobs.incremental_job(spark, raw, lo, cut - 1, tp, mp, ap)
    jobs.incremental_job(spark, raw, cut, hi, tp, mp, ap)
    out = _tables.read_metrics(spark, mp).select("crypto_id", "collection_timestamp", "price_usd", "price_ma_24h", "volume_ma_24h")
    return rounded(out, "price_ma_24h", "volume_ma_24h")


# ---------------------------------------------------------------------------
# Market charts; S1b quarantine; S13 daily layout; P14 text lines.


CHART_POINTS_CTE = VALID_CTE + f""",
points AS (
  SELECT crypto_id || '@' || CAST({HOUR} AS VARCHAR) AS chart_id, 'prices' AS series, collection_timestamp * 1000 AS ts_ms, seq,
         price_usd AS value FROM valid
  UNION ALL
  SELECT crypto_id || '@' || CAST({HOUR} AS VARCHAR), 'total_volumes', collection_timestamp * 1000, seq, volume_24h_usd
  FROM valid WHERE seq % 2 = 0),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY chart_id, series ORDER BY ts_ms, seq) - 1 AS INTEGER) AS idx FROM points)"""


def _charts(spark: SparkSession, sf: str) -> DataFrame:
    from tickwatch.sources import market_chart

    return market_chart.decode(testdata.chart_bodies(spark, sf))


@register("chart_points", f"WITH {CHART_POINTS_CTE} SELECT chart_id, series, idx, ts_ms, value FROM placed")
def q_chart_points(spark: SparkSession, sf: str) -> DataFrame:
    from tickwatch.sources import market_chart

    return market_chart.points(_charts(spark, sf)).drop("ts")


@register(
    "chart_sizes",
    f"""WITH {CHART_POINTS_CTE}
SELECT chart_id, CAST(count_if(series = 'prices') AS INTEGER) AS prices_points, CAST(0 AS INTEGER) AS market_caps_points,
       CAST(count_if(series = 'total_volumes') AS INTEGER) AS total_volumes_points FROM placed GROUP BY chart_id""",
)
def q_chart_sizes(spark: SparkSession, sf: str) -> DataFrame:
    from tickwatch.sources import market_chart

    return market_chart.series_sizes(_charts(spark, sf))


@register(
    "chart_first_points",
    f"WITH {CHART_POINTS_CTE} SELECT chart_id, idx, ts_ms // 1000 AS ts_s, value AS price FROM placed WHERE series = 'prices' AND idx < 3",
)
def q_chart_first_points(spark: SparkSession, sf: str) -> DataFrame:
    from tickwatch.sources import market_chart

    first = market_chart.first_points(_charts(spark, sf))
    return first.select("chart_id", "idx", F.unix_seconds("ts").alias("ts_s"), "price")


@register(
    "quarantined_lines",
    f"""WITH {TICKS_CTE}
SELECT '{{"metadata": broken ' || CAST(seq AS VARCHAR) AS raw_line,
       strftime(make_timestamp(collection_timestamp * 1000000), '%Y-%m-%d-%H') AS hour FROM ticks WHERE seq % 20 = 0""",
)
def q_quarantined_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Broken lines landed among good envelopes come back as quarantined, with their hour."""
    root = scratch_path(spark, "raw")
    ticks = testdata.ticks(spark, sf)
    _envelopes.land_envelopes(_flatten.envelopes_from_ticks(ticks, testdata.EVENT_KEYS), root)
    broken = landing_columns(ticks.where("seq % 20 = 0"), "collection_timestamp").select(
        F.concat(F.lit('{"metadata": broken '), F.col("seq").cast("string")).alias("value"), *_envelopes.PARTITIONS)
    broken.write.mode("append").partitionBy(*_envelopes.PARTITIONS).text(root)
    return _envelopes.quarantine(spark, root).select("raw_line", F.concat_ws("-", *_envelopes.PARTITIONS).alias("hour"))


@register(
    "expired_tables",
    f"""WITH {VALID_CTE},
kept AS (SELECT 'metrics' AS name, collection_timestamp AS t, crypto_id FROM valid
         UNION ALL SELECT 'raw', collection_timestamp, crypto_id FROM ticks)
SELECT name, CAST(make_timestamp(t * 1000000) AS DATE) AS day, crypto_id, count(*) AS n FROM kept
WHERE CAST(make_timestamp(t * 1000000) AS DATE) > DATE '2024-02-09' - INTERVAL 20 DAY GROUP BY ALL""",
)
def q_expired_tables(spark: SparkSession, sf: str) -> DataFrame:
    """S12 on storage: the metrics table and the landed envelopes after everything older than 20 days was removed."""
    import datetime as dt

    from tickwatch.schemas import METRICS

    as_of, days = dt.date(2024, 2, 9), 20
    metrics_path, raw = scratch_path(spark, "metrics"), scratch_path(spark, "raw")
    ticks = _flatten.ticks_only(testdata.ticks(spark, sf)).drop("seq")
    _tables.write_metrics(filter_valid(add_time_columns(ticks)), metrics_path)
    _envelopes.land_envelopes(_flatten.envelopes_from_ticks(ticks, testdata.EVENT_KEYS), raw)
    _tables.expire_dates(spark, metrics_path, "collection_date", METRICS, as_of, days)
    _envelopes.expire_raw(spark, raw, as_of, days)
    left = add_time_columns(_flatten.explode_and_flatten(_envelopes.read_envelopes(spark, raw)))
    both = _tables.read_metrics(spark, metrics_path).select(F.lit("metrics").alias("name"), F.col("collection_date").alias("day"), "crypto_id")
    both = both.unionByName(left.select(F.lit("raw").alias("name"), F.col("collection_date").alias("day"), "crypto_id"))
    return both.groupBy("name", "day", "crypto_id").agg(F.count("*").alias("n"))


@register(
    "daily_outputs_twice",
    f"""WITH {METRICS_CTE},
w AS (SELECT crypto_id, (collection_timestamp // 900) * 900 AS window_start, count(*) AS readings FROM metrics GROUP BY ALL)
SELECT crypto_id, window_start, readings, CAST(year(make_timestamp(window_start * 1000000)) AS INTEGER) AS year,
       CAST(month(make_timestamp(window_start * 1000000)) AS INTEGER) AS month,
       CAST(day(make_timestamp(window_start * 1000000)) AS INTEGER) AS day FROM w""",
)
def q_daily_outputs_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The windowed aggregates in the daily layout; a rerun replaces its days."""
    root = scratch_path(spark, "daily")
    windows = reports.window_aggregates(_valid(spark, sf), 15)
    for _ in range(2):
        _tables.write_daily(windows, root, "aggregated_metrics", "window_start")
    days = [F.col(c).cast("int").alias(c) for c in ("year", "month", "day")]
    return spark.read.parquet(f"{root}/aggregated_metrics").select("crypto_id", "window_start", "readings", *days)


@register(
    "report_lines",
    f"""WITH {METRICS_CTE}, n AS (SELECT crypto_id, count(*) AS n FROM metrics GROUP BY 1)
SELECT '  ' || lpad(crypto_id, 15, ' ') || ': ' || lpad(format('{{:,}}', n), 5, ' ') || ' records' AS line FROM n""",
)
def q_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    return reports.records_per_key_lines(reports.records_per_key(_valid(spark, sf)))
