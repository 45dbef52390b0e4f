"""Derived time columns (P7) and landing partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_time_columns(df: DataFrame, ts_col: str = "collection_timestamp") -> DataFrame:
    """``collection_datetime`` (text), ``collection_date``, ``_hour``, ``_minute``.

    The text column keeps the ``from_unixtime`` form; the parts are derived
    from a real timestamp so they do not re-parse text. Values follow the
    session time zone, which :mod:`tickwatch.session` pins to UTC.
    """
    ts = F.timestamp_seconds(F.col(ts_col))
    return df.withColumns(
        {
            "collection_datetime": F.from_unixtime(F.col(ts_col)),
            "collection_date": F.to_date(ts),
            "collection_hour": F.hour(ts),
            "collection_minute": F.minute(ts),
        }
    )


def landing_columns(df: DataFrame, ts_col: str = "collection_timestamp") -> DataFrame:
    """Landing layout parts: ``year``, zero-padded ``month``/``day``/``hour``,
    and the object name ``crypto_prices_yyyyMMdd_HHmmss.json`` (UTC)."""
    ts = F.timestamp_seconds(F.col(ts_col))
    return df.withColumns(
        {
            "year": F.date_format(ts, "yyyy"),
            "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd"),
            "hour": F.date_format(ts, "HH"),
            "file_name": F.concat(F.lit("crypto_prices_"), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit(".json")),
        }
    )


def landing_key(df: DataFrame, ts_col: str = "collection_timestamp") -> DataFrame:
    """Adds ``object_key = year=Y/month=MM/day=DD/hour=HH/<file_name>``."""
    with_parts = landing_columns(df, ts_col)
    return with_parts.withColumn(
        "object_key",
        F.format_string(
            "year=%s/month=%s/day=%s/hour=%s/%s", "year", "month", "day", "hour", "file_name"
        ),
    )
