"""Validity filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_condition() -> Column:
    """Positive price, positive volume, non-null key. Nulls fail."""
    return (F.col("price_usd") > 0) & (F.col("volume_24h_usd") > 0) & F.col("crypto_id").isNotNull()


def filter_valid(df: DataFrame) -> DataFrame:
    """Keep valid rows. Applied *after* the moving averages (zeros and
    negatives count in the averages, nulls are skipped by ``avg``)."""
    return df.where(valid_condition())


def invalid_rows(df: DataFrame) -> DataFrame:
    """The complement, for quarantine or reporting (null predicates count as invalid)."""
    return df.where(~F.coalesce(valid_condition(), F.lit(False)))
