"""Price API answers landed as text: decode (S2) and turn into rows.

An answer is one JSON object keyed by id: ``{"bitcoin": {"usd": ..., ...}}``.
Bodies are decoded in parallel with ``from_json`` and exploded; malformed
text decodes to null and yields no rows (it is reported by
:func:`undecodable` and named by :func:`decode_error`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.schemas import PRICE_ANSWER, PRICE_QUOTE


def decode(bodies: DataFrame, body_col: str = "body", value_type: T.DataType = PRICE_QUOTE) -> DataFrame:
    """Adds ``answer: map<string, value_type>`` (null when malformed)."""
    return bodies.withColumn("answer", F.from_json(F.col(body_col), T.MapType(T.StringType(), value_type)))


def undecodable(decoded: DataFrame, body_col: str = "body") -> DataFrame:
    return decoded.where(F.col("answer").isNull() & F.col(body_col).isNotNull())


def _complete(quote: Column) -> Column:
    cond = quote.isNotNull()
    for f in PRICE_QUOTE.fields:
        cond = cond & quote[f.name].isNotNull()
    return cond


# Our error texts of answers that cannot be used.
NOT_JSON = "Could not decode the price answer"
INCOMPLETE = "Incomplete quote in the price answer"


def decode_error(body: str | Column = "body", strict: bool = True) -> Column:
    """Text of a decode failure, null for a usable answer: a body that is no
    JSON object, or with ``strict`` (the collector's all-or-nothing decode) an
    answer in which a quote lacks a field."""
    body = F.col(body) if isinstance(body, str) else body
    answer = F.col("answer")
    out = F.when(answer.isNull() | body.isNull(), F.lit(NOT_JSON))
    return out.when(~F.forall(F.map_values(answer), _complete), F.lit(INCOMPLETE)) if strict else out


def answer_to_rows(decoded: DataFrame, collection_ts: str | Column, strict: bool = False) -> DataFrame:
    """One flat tick per key of the answer, stamped with the collection
    time (``collected_at``); the source's own clock stays in
    ``last_updated_at``.

    ``strict=True`` reproduces the collector's all-or-nothing decode: an
    answer with any missing field contributes no rows at all. The default
    keeps the complete keys of a partly broken answer and nulls the rest.
    """
    ts = F.col(collection_ts) if isinstance(collection_ts, str) else collection_ts
    answer = F.col("answer")
    if strict:
        answer = F.when(F.forall(F.map_values(answer), _complete), answer)
    # explode_outer + a filter on the generated key (rather than explode and
    # a filter on the answer): no predicate over the decoded map can then be
    # pushed below the projection, so each body is parsed exactly once.
    q = F.col("quote")
    exploded = decoded.select(
        ts.cast("long").alias("_cts"), F.explode_outer(answer).alias("crypto_id", "quote")
    ).where(F.col("crypto_id").isNotNull())
    return exploded.select(
        F.col("_cts").alias("collection_timestamp"),
        "crypto_id",
        q["usd"].alias("price_usd"),
        q["brl"].alias("price_brl"),
        q["usd_24h_vol"].alias("volume_24h_usd"),
        q["usd_24h_change"].alias("change_24h_pct"),
        q["last_updated_at"].alias("last_updated_at"),
        F.col("_cts").alias("collected_at"),
    )


def encode(ticks: DataFrame) -> DataFrame:
    """The inverse of :func:`answer_to_rows` for one row: an answer body
    ``{"<crypto_id>": {...}}`` per tick (used to build fixtures from tables)."""
    quote = F.struct(
        F.col("price_usd").alias("usd"),
        F.col("price_brl").alias("brl"),
        F.col("volume_24h_usd").alias("usd_24h_vol"),
        F.col("change_24h_pct").alias("usd_24h_change"),
        F.col("last_updated_at").alias("last_updated_at"),
    )
    return ticks.withColumn("body", F.to_json(F.create_map(F.col("crypto_id"), quote)))


ANSWER_TYPE = PRICE_ANSWER
