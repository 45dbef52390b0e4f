"""Table contracts of the tick pipeline as Spark ``StructType``s.

Every reader in :mod:`tickwatch.sources` passes one of these explicitly so no
job depends on schema inference (which is slow on large JSON and turns
numeric-looking partition values into ints).
"""

from __future__ import annotations

from pyspark.sql import types as T

# One price row inside a collection envelope (camel case, as landed).
PRICE_ROW = T.StructType(
    [
        T.StructField("cryptoId", T.StringType()),
        T.StructField("usd", T.DoubleType()),
        T.StructField("brl", T.DoubleType()),
        T.StructField("usd24hVol", T.DoubleType()),
        T.StructField("usd24hChange", T.DoubleType()),
        T.StructField("lastUpdatedAt", T.LongType()),
        T.StructField("collectedAt", T.LongType()),
    ]
)

COLLECTION_METADATA = T.StructType(
    [
        T.StructField("collectionTimestamp", T.LongType()),
        T.StructField("totalCryptos", T.IntegerType()),
        T.StructField("successCount", T.IntegerType()),
        T.StructField("failureCount", T.IntegerType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
    ]
)

# A landed collection: one JSON object per line.
ENVELOPE = T.StructType(
    [
        T.StructField("metadata", COLLECTION_METADATA),
        T.StructField("data", T.ArrayType(PRICE_ROW)),
    ]
)

# Value type of the price API answer ``{"<id>": {...}, ...}``.
PRICE_QUOTE = T.StructType(
    [
        T.StructField("usd", T.DoubleType()),
        T.StructField("brl", T.DoubleType()),
        T.StructField("usd_24h_vol", T.DoubleType()),
        T.StructField("usd_24h_change", T.DoubleType()),
        T.StructField("last_updated_at", T.LongType()),
    ]
)
PRICE_ANSWER = T.MapType(T.StringType(), PRICE_QUOTE)

# Flat per-key ticks (output of the explode/flatten step). ``seq`` is our
# tie-breaker for rows that share a timestamp; it is optional on input.
FLAT_TICKS = T.StructType(
    [
        T.StructField("collection_timestamp", T.LongType()),
        T.StructField("crypto_id", T.StringType()),
        T.StructField("price_usd", T.DoubleType()),
        T.StructField("price_brl", T.DoubleType()),
        T.StructField("volume_24h_usd", T.DoubleType()),
        T.StructField("change_24h_pct", T.DoubleType()),
        T.StructField("last_updated_at", T.LongType()),
        T.StructField("collected_at", T.LongType()),
    ]
)
TICK_COLUMNS = [f.name for f in FLAT_TICKS.fields]

TIME_COLUMNS = T.StructType(
    [
        T.StructField("collection_datetime", T.StringType()),
        T.StructField("collection_date", T.DateType()),
        T.StructField("collection_hour", T.IntegerType()),
        T.StructField("collection_minute", T.IntegerType()),
    ]
)

MOVING_AVERAGES = T.StructType(
    [
        T.StructField("price_ma_24h", T.DoubleType()),
        T.StructField("volume_ma_24h", T.DoubleType()),
        T.StructField("price_ma_15min", T.DoubleType()),
    ]
)

METRICS = T.StructType(FLAT_TICKS.fields + TIME_COLUMNS.fields + MOVING_AVERAGES.fields)
METRIC_COLUMNS = [f.name for f in METRICS.fields]

ANOMALIES = T.StructType(
    [
        T.StructField("crypto_id", T.StringType()),
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("detected_at", T.LongType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("reference_value", T.DoubleType()),
        T.StructField("variation_pct", T.DoubleType()),
        T.StructField("description", T.StringType()),
    ]
)
ANOMALY_COLUMNS = [f.name for f in ANOMALIES.fields]
STORED_ANOMALIES = T.StructType(ANOMALIES.fields + [T.StructField("detection_date", T.DateType())])

ALERTS = T.StructType(
    [
        T.StructField("crypto_id", T.StringType()),
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("variation_pct", T.DoubleType()),
        T.StructField("description", T.StringType()),
        T.StructField("detected_at", T.LongType()),
    ]
)

DELIVERY_RESULT = T.StructType(
    [
        T.StructField("alert_key", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("detected_at", T.LongType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# The outbox: one row per delivery attempt, partitioned by the anomaly's detection date.
OUTBOX = T.StructType([T.StructField("run_id", T.StringType()), *DELIVERY_RESULT.fields, T.StructField("detection_date", T.DateType())])

RUN_LOG = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("pipeline_stage", T.StringType()),
        T.StructField("cryptos_processed", T.IntegerType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("anomalies_detected", T.LongType()),
        T.StructField("alerts_sent", T.IntegerType()),
        T.StructField("execution_time_ms", T.LongType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("error_message", T.StringType()),
    ]
)
RUN_LOG_COLUMNS = [f.name for f in RUN_LOG.fields]
# The text form of the run log (CSV import): every field read as a string so a
# bad number becomes 0 instead of nulling or dropping the row.
RUN_LOG_STRINGS = T.StructType([T.StructField(f.name, T.StringType()) for f in RUN_LOG.fields])

_SERIES = T.ArrayType(T.ArrayType(T.DoubleType()))
MARKET_CHART = T.StructType(
    [
        T.StructField("prices", _SERIES),
        T.StructField("market_caps", _SERIES),
        T.StructField("total_volumes", _SERIES),
    ]
)
CHART_SERIES = ("prices", "market_caps", "total_volumes")
