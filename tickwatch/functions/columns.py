"""Small column-expression helpers shared by the operators.

All of these build JVM-side Catalyst expressions; nothing here runs Python per
row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Null (not an error) on a zero denominator, under ANSI mode as well."""
    return F.try_divide(col_of(numerator), col_of(denominator))


def pct_change(current: Column | str, reference: Column | str) -> Column:
    """``(current - reference) / reference * 100``; null when reference is 0."""
    cur, ref = col_of(current), col_of(reference)
    return ratio(cur - ref, ref) * F.lit(100.0)


def tiers(value: Column | str, high: float, medium: float) -> Column:
    """Severity with strict bounds: ``> high`` high, ``> medium`` medium, else low."""
    v = col_of(value)
    return F.when(v > high, F.lit("high")).when(v > medium, F.lit("medium")).otherwise(F.lit("low"))


def fmt2(value: Column | str) -> Column:
    """Number with thousands separators and two decimals, e.g. ``1,234.50``."""
    return F.format_number(col_of(value), 2)


def double_text(value: Column | str) -> Column:
    """A double printed the JVM way (``70956.0``, ``4.0E10``)."""
    return col_of(value).cast("string")


def epoch_text(epoch_seconds: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds formatted in the session time zone (UTC by default)."""
    return F.date_format(F.timestamp_seconds(col_of(epoch_seconds)), pattern)


def lenient_long(text: Column | str) -> Column:
    """Trimmed text parsed as a long, 0 when it is not a number."""
    return F.coalesce(F.trim(col_of(text)).try_cast("bigint"), F.lit(0).cast("bigint"))
