"""Envelope <-> flat tick conversions and collection coverage.

* :func:`explode_and_flatten` — envelopes to one row per price (P6).
* :func:`envelopes_from_answers` — one envelope per decoded answer (P2, P3);
  :func:`envelopes_from_ticks` — the same for answers of a single key.
* :func:`collection_coverage` / :func:`missing_keys` — expected vs fetched keys
  per collection (P4, P5, J1, A8).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.schemas import ENVELOPE, TICK_COLUMNS

# The five keys the collector requests by default.
DEFAULT_KEYS = ("bitcoin", "ethereum", "cardano", "binancecoin", "solana")

# Fixed value: prefix of the per-key error line written into the envelope.
MISSING_PREFIX = "Missing data for crypto: "


def explode_and_flatten(envelopes: DataFrame) -> DataFrame:
    """One row per element of ``data``; empty or null ``data`` gives no rows.

    ``explode`` (not ``explode_outer``) is deliberate: an envelope that only
    carries an error contributes nothing to the tick table. Catalyst infers
    ``size(data) > 0`` from the generator and pushes it to the scan.
    """
    item = F.col("item")
    return envelopes.select(
        F.col("metadata.collectionTimestamp").alias("collection_timestamp"),
        F.explode("data").alias("item"),
    ).select(
        "collection_timestamp",
        item["cryptoId"].alias("crypto_id"),
        item["usd"].alias("price_usd"),
        item["brl"].alias("price_brl"),
        item["usd24hVol"].alias("volume_24h_usd"),
        item["usd24hChange"].alias("change_24h_pct"),
        item["lastUpdatedAt"].alias("last_updated_at"),
        item["collectedAt"].alias("collected_at"),
    )


# Field names of a price row inside an envelope and their sources in a quote (fixed by the envelope schema).
QUOTE_FIELDS = {"usd": "usd", "brl": "brl", "usd24hVol": "usd_24h_vol", "usd24hChange": "usd_24h_change",
                "lastUpdatedAt": "last_updated_at"}


def _envelope(ts: Column, data: Column, keys: Column, error: Column, expected_keys: Sequence[str]) -> list[Column]:
    """``metadata`` and ``data`` of one answer; with an ``error`` the envelope is empty and carries it."""
    total = len(expected_keys)
    expected = F.array(*[F.lit(k) for k in expected_keys]) if expected_keys else F.array().cast("array<string>")
    missing = F.transform(F.array_except(expected, keys), lambda k: F.concat(F.lit(MISSING_PREFIX), k))
    failed = error.isNotNull()
    data = F.when(failed, F.array().cast(ENVELOPE["data"].dataType)).otherwise(data)
    count = F.when(failed, F.lit(0)).otherwise(F.size(keys))
    metadata = F.struct(
        ts.cast("long").alias("collectionTimestamp"),
        F.lit(total).alias("totalCryptos"),
        count.alias("successCount"),
        (F.lit(total) - count).alias("failureCount"),
        F.when(failed, F.array(error)).otherwise(missing).alias("errors"),
    )
    return [metadata.alias("metadata"), data.alias("data")]


def envelopes_from_answers(
    decoded: DataFrame,
    ts_col: str = "collection_timestamp",
    expected_keys: Sequence[str] = DEFAULT_KEYS,
    error: Column | None = None,
) -> DataFrame:
    """One ``{metadata, data}`` envelope per answer, row by row (no shuffle).

    ``decoded`` holds ``answer: map<string, quote>``; ``error`` is the text of a
    fetch or decode failure, null for a good answer. A failed answer gives an
    empty envelope with that text as its only error (P3). Otherwise
    ``successCount`` counts the answer's keys, ``failureCount`` is
    ``len(expected_keys) - successCount`` (negative when an answer carries
    keys that were not requested, as in the collector) and ``errors`` lists
    the expected keys that are absent.
    """
    ts, answer = F.col(ts_col), F.col("answer")
    error = F.lit(None).cast("string") if error is None else error
    data = F.transform(
        F.map_entries(answer),
        lambda e: F.struct(
            e["key"].alias("cryptoId"),
            *[e["value"][source].alias(name) for name, source in QUOTE_FIELDS.items()],
            ts.cast("long").alias("collectedAt"),
        ),
    )
    return decoded.select(*_envelope(ts, data, F.map_keys(answer), error, expected_keys))


def envelopes_from_ticks(ticks: DataFrame, expected_keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """One envelope per flat row, read as an answer of a single key."""
    c = F.col
    row = F.struct(
        c("crypto_id").alias("cryptoId"),
        c("price_usd").alias("usd"),
        c("price_brl").alias("brl"),
        c("volume_24h_usd").alias("usd24hVol"),
        c("change_24h_pct").alias("usd24hChange"),
        c("last_updated_at").alias("lastUpdatedAt"),
        c("collected_at").alias("collectedAt"),
    )
    none = F.lit(None).cast("string")
    return ticks.select(*_envelope(c("collection_timestamp"), F.array(row), F.array("crypto_id"), none, expected_keys))


def collection_coverage(
    ticks: DataFrame,
    expected_keys: Sequence[str] = DEFAULT_KEYS,
    collection_col: str | Column = "collection_timestamp",
) -> DataFrame:
    """Per collection: expected, fetched and failed key counts plus row count.

    ``success_count`` counts distinct keys in the answer (extra keys included),
    ``failure_count = expected - success`` (may be negative), ``missing_count``
    counts expected keys that were not fetched. The key set per collection
    is never materialised.
    """
    coll = F.col(collection_col) if isinstance(collection_col, str) else collection_col
    total = len(expected_keys)
    # Distinct (collection, key) pairs first — a map-side combined
    # aggregation, so a hot collection shrinks to its distinct keys before
    # the shuffle — then one row per collection.
    pairs = (
        ticks.select(coll.alias("collection"), "crypto_id")
        .groupBy("collection", "crypto_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        pairs.groupBy("collection")
        .agg(
            F.sum("_n").alias("rows_collected"),
            F.count("crypto_id").alias("success_count"),
            F.count_if(F.col("crypto_id").isin(list(expected_keys))).alias("_hit"),
        )
        .select(
            "collection",
            F.lit(total).alias("total_expected"),
            F.col("success_count").cast("int").alias("success_count"),
            (F.lit(total) - F.col("success_count")).cast("int").alias("failure_count"),
            (F.lit(total) - F.col("_hit")).cast("int").alias("missing_count"),
            "rows_collected",
        )
    )


def missing_keys(
    ticks: DataFrame,
    expected_keys: Sequence[str] = DEFAULT_KEYS,
    collection_col: str | Column = "collection_timestamp",
) -> DataFrame:
    """One row per (collection, expected key not fetched) with its error line.

    One aggregation per collection collects the set of *expected* keys seen
    (never more than ``len(expected_keys)`` elements, combined map-side), and
    ``array_except`` against the configured list yields the missing ones —
    no join and no per-collection list of all keys.
    """
    coll = F.col(collection_col) if isinstance(collection_col, str) else collection_col
    expected = F.array(*[F.lit(k) for k in expected_keys])
    seen = F.collect_set(F.when(F.col("crypto_id").isin(list(expected_keys)), F.col("crypto_id")))
    per = ticks.select(coll.alias("collection"), "crypto_id").groupBy("collection").agg(seen.alias("_seen"))
    return per.select("collection", F.explode(F.array_except(expected, F.col("_seen"))).alias("crypto_id")).select(
        "collection",
        "crypto_id",
        F.concat(F.lit(MISSING_PREFIX), F.col("crypto_id")).alias("error"),
    )


def ticks_only(df: DataFrame) -> DataFrame:
    """Project the eight flat-tick columns (plus ``seq`` when present)."""
    cols = list(TICK_COLUMNS) + (["seq"] if "seq" in df.columns else [])
    return df.select(*cols)
