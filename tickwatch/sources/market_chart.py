"""Market-chart answers (S11) and their summaries.

An answer holds three parallel series ``[[epoch_ms, value], ...]``
(``prices``, ``market_caps``, ``total_volumes``). Bodies are decoded with
``from_json`` and exploded to one row per point, so the statistics are
ordinary distributed aggregations over points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.functions.columns import pct_change
from tickwatch.schemas import CHART_SERIES, MARKET_CHART


def decode(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """Adds ``chart: struct<prices, market_caps, total_volumes>``."""
    return bodies.withColumn("chart", F.from_json(F.col(body_col), MARKET_CHART))


def series_sizes(decoded: DataFrame, id_col: str = "chart_id") -> DataFrame:
    """Points per series (0 when a series is missing)."""
    return decoded.select(
        id_col,
        *[F.coalesce(F.size(F.col("chart")[s]), F.lit(0)).alias(f"{s}_points") for s in CHART_SERIES],
    )


def first_points(decoded: DataFrame, n: int = 3, id_col: str = "chart_id") -> DataFrame:
    """The first ``n`` price points of each chart, as rows."""
    return decoded.select(
        id_col, F.posexplode(F.slice(F.col("chart.prices"), 1, n)).alias("idx", "point")
    ).select(
        id_col,
        "idx",
        F.timestamp_millis(F.col("point")[0].cast("long")).alias("ts"),
        F.col("point")[1].alias("price"),
    )


def points(decoded: DataFrame, id_col: str = "chart_id") -> DataFrame:
    """One row per point: ``chart_id, series, idx, ts_ms, ts, value``."""
    tagged = F.array(*[F.struct(F.lit(s).alias("series"), F.col("chart")[s].alias("pts")) for s in CHART_SERIES])
    per_series = decoded.select(id_col, F.explode(tagged).alias("s")).select(
        id_col, F.col("s.series").alias("series"), F.posexplode(F.col("s.pts")).alias("idx", "p")
    )
    return per_series.select(
        id_col,
        "series",
        "idx",
        F.col("p")[0].cast("long").alias("ts_ms"),
        F.timestamp_millis(F.col("p")[0].cast("long")).alias("ts"),
        F.col("p")[1].alias("value"),
    )


def chart_stats(chart_points: DataFrame, id_col: str = "chart_id") -> DataFrame:
    """A12 + A13 over point rows: count, min, max and
    ``(max - min) / min * 100`` (only with at least two points)."""
    agg = chart_points.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("points"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )
    return agg.withColumn(
        "variation_pct", F.when(F.col("points") >= 2, pct_change("max_value", "min_value"))
    )
