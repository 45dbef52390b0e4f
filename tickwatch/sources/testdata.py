"""Adapters from the driver's generated tables to the pipeline's inputs.

The generated ``events`` table stands in for landed price ticks (five
``event_type`` values play the five keys) and ``orders`` for the run log.
Everything is a projection, so the work grows with the tables.

Tick adapter (fixed mapping, mirrored by the SQL oracles in
``__spark_entry__.py``):

* ``crypto_id = event_type``, ``collection_timestamp = unix_seconds(ts)``,
  ``seq = event_id`` (tie-breaker for equal timestamps)
* ``price_usd = value``, except null when ``event_id % 101 = 0`` and 0 when
  ``event_id % 97 = 0`` (invalid prices that must be averaged, then dropped)
* ``price_brl = value * 5``, ``volume_24h_usd = value``,
  ``change_24h_pct = (value - 50) / 5``
* ``last_updated_at = collection_timestamp - 60``, ``collected_at = collection_timestamp``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The key set of the generated events.
EVENT_KEYS = ("click", "error", "purchase", "signup", "view")

_EVENT_COLUMNS = ["event_id", "ts", "event_type", "value"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a timestamp (NTZ read as UTC wall time)."""
    return F.unix_seconds(ts.cast("timestamp"))


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Flat ticks plus ``seq`` from the generated events table."""
    ts = epoch_seconds(F.col("ts"))
    value = F.col("value")
    price = (
        F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("double"))
        .when(F.col("event_id") % 97 == 0, F.lit(0.0))
        .otherwise(value)
    )
    return events.select(*_EVENT_COLUMNS).select(
        ts.alias("collection_timestamp"),
        F.col("event_type").alias("crypto_id"),
        price.alias("price_usd"),
        (value * 5).alias("price_brl"),
        value.alias("volume_24h_usd"),
        ((value - 50) / 5).alias("change_24h_pct"),
        (ts - 60).alias("last_updated_at"),
        ts.alias("collected_at"),
        F.col("event_id").alias("seq"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(table(spark, sf_dir, "events"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price answers from the events: one per five consecutive event ids, the
    last event of a type being that key's quote, stamped with the earliest
    time. Every 13th body is cut off and every 17th an empty object; a null
    price leaves its field out."""
    quote = F.struct(
        F.col("price_usd").alias("usd"), F.col("price_brl").alias("brl"), F.col("volume_24h_usd").alias("usd_24h_vol"),
        F.col("change_24h_pct").alias("usd_24h_change"), F.col("last_updated_at").alias("last_updated_at"),
    )
    rows = ticks(spark, sf_dir).withColumn("answer_id", F.expr("seq div 5"))
    per_key = rows.groupBy("answer_id", "crypto_id").agg(
        F.min("collection_timestamp").alias("first"), F.max_by(quote, F.col("seq")).alias("quote"))
    grouped = per_key.groupBy("answer_id").agg(  # at most five quotes
        F.min("first").alias("collection_timestamp"),
        F.to_json(F.map_from_entries(F.collect_list(F.struct("crypto_id", "quote")))).alias("body"))
    body = F.when(F.col("answer_id") % 13 == 0, F.expr("left(body, length(body) - 9)")).when(
        F.col("answer_id") % 17 == 0, F.lit("{}")).otherwise(F.col("body"))
    return grouped.select("answer_id", "collection_timestamp", body.alias("body"))


def chart_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market-chart answers from the valid ticks: one per key and hour, prices
    in time order, volumes of every other event, no market caps."""
    rows = ticks(spark, sf_dir).where("price_usd > 0 AND volume_24h_usd > 0 AND crypto_id IS NOT NULL")
    hour = F.expr("collection_timestamp div 3600 * 3600").cast("string")
    ms = (F.col("collection_timestamp") * 1000).cast("double")

    def series(value: str, where: Column) -> Column:
        points = F.array_sort(F.collect_list(F.when(where, F.struct("collection_timestamp", "seq", F.array(ms, F.col(value)).alias("p")))))
        return F.transform(points, lambda x: x["p"])

    return rows.groupBy(F.concat_ws("@", "crypto_id", hour).alias("chart_id")).agg(
        F.to_json(F.struct(series("price_usd", F.lit(True)).alias("prices"),
                           series("volume_24h_usd", F.col("seq") % 2 == 0).alias("total_volumes"))).alias("body"))


def run_log_text_from_orders(orders: DataFrame) -> DataFrame:
    """Run-log rows as text fields (the CSV form), one run per order.

    ``timestamp`` = order date, ``pipeline_stage`` = order priority,
    ``records_processed`` = customer key, ``anomalies_detected`` = whole
    dollars of the total price, ``execution_time_ms`` = order key,
    ``success`` = status is not ``P``, with an error text otherwise.
    """
    ok = F.col("o_orderstatus") != F.lit("P")
    return orders.select(
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("o_orderpriority").alias("pipeline_stage"),
        F.lit("5").alias("cryptos_processed"),
        F.col("o_custkey").cast("string").alias("records_processed"),
        F.floor(F.col("o_totalprice")).cast("string").alias("anomalies_detected"),
        F.lit("0").alias("alerts_sent"),
        F.col("o_orderkey").cast("string").alias("execution_time_ms"),
        F.when(ok, F.lit("true")).otherwise(F.lit("false")).alias("success"),
        F.when(ok, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" pending")))
        .alias("error_message"),
    )
