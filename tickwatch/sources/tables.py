"""Parquet tables: metrics (S4, S6), anomalies (S5, S7, J2), retention (S12),
daily layout (S13).

Reads always pass an explicit schema: partition values such as a numeric
looking key stay strings, and no inference pass runs over the files.
Writes are rebalanced on the partition columns first (AQE splits a hot
partition across tasks instead of writing it from one).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.schemas import ANOMALY_COLUMNS, METRICS, STORED_ANOMALIES
from tickwatch.sources import files

METRIC_PARTITIONS = ("collection_date", "crypto_id")
ANOMALY_PARTITIONS = ("detection_date", "severity")
# What makes two stored anomalies the same: the rule, the key, the second and the reading itself.
ANOMALY_KEY = ("crypto_id", "anomaly_type", "detected_at", "current_price")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, asked of the path's own file
    system. Only "path not found" means no; every other failure is raised."""
    try:
        spark.read.schema("x int").parquet(path)  # lists the path, opens no file
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


# --- metrics ----------------------------------------------------------------

def write_metrics(metrics: DataFrame, path: str, replace: str = "all") -> None:
    """Parquet by ``collection_date, crypto_id``.

    ``replace="all"`` overwrites the table (the batch recomputes all
    history); ``replace="dates"`` replaces only the partitions present in
    ``metrics`` (incremental runs: recompute from the earliest changed date
    and rewrite those dates).
    """
    mode = "dynamic" if replace == "dates" else "static"
    (
        metrics.hint("rebalance", *METRIC_PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*METRIC_PARTITIONS)
        .parquet(path)
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """S6 (partition columns come back last from the scan; the contract's
    column order is restored)."""
    return spark.read.schema(METRICS).parquet(path).select(*METRICS.fieldNames())


# --- anomalies --------------------------------------------------------------

def with_detection_date(anomalies: DataFrame) -> DataFrame:
    return anomalies.withColumn("detection_date", F.to_date(F.from_unixtime(F.col("detected_at"))))


def save_anomalies(anomalies: DataFrame, path: str, dedup: bool = True) -> bool:
    """S5 (+J2): append anomalies by ``detection_date, severity``.

    Skips the write when there is nothing to save (a one-row probe). With
    ``dedup`` rows already stored under the same :data:`ANOMALY_KEY` are
    removed first by a left-anti join against only the dates present in the
    batch (static partition pruning on ``detection_date``), so saving a batch
    twice stores it once. Different readings of one second are different
    anomalies, in one batch or in two. Repeats inside one batch are kept. Several
    writers may save to one table: the batch is worked out beside the others, and from the
    look at what is stored to the end of the write one holds the table's claim
    (:func:`tickwatch.sources.files.sole_writer`). The batch is staged for the probe, the date lookup and
    the write (:func:`tickwatch.sources.files.staged`). Returns whether anything was written.
    """
    spark = anomalies.sparkSession
    with files.staged(with_detection_date(anomalies.select(*ANOMALY_COLUMNS)), "anomalies-batch") as batch:
        if batch.isEmpty():
            return False
        with files.sole_writer(spark, path):
            _append_new(batch, path, dedup)
        return True


def _append_new(batch: DataFrame, path: str, dedup: bool) -> None:
    """Append the rows of ``batch`` (with ``detection_date``) that the table does not hold."""
    spark, out = batch.sparkSession, batch
    if dedup and table_exists(spark, path):
        # Bounded by the number of distinct days in the batch.
        dates = [r[0] for r in batch.select("detection_date").distinct().collect()]
        stored = read_anomalies(spark, path).where(F.col("detection_date").isin(dates))
        identity = ["detection_date", *ANOMALY_KEY]
        known = stored.select(*[F.col(c).alias(f"_{c}") for c in identity]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in identity]
        out = batch.join(known, same, "left_anti")
    (
        out.hint("rebalance", *ANOMALY_PARTITIONS)
        .write.mode("append")
        .partitionBy(*ANOMALY_PARTITIONS)
        .parquet(path)
    )


def replace_anomaly_dates(anomalies: DataFrame, path: str, dates: Iterable[dt.date]) -> None:
    """Recompute mode: replace whole detection dates (a late file may move an
    old anomaly to another severity). Each date directory is overwritten
    statically, so a date with no anomalies left becomes empty."""
    batch = with_detection_date(anomalies.select(*ANOMALY_COLUMNS))
    root = path.rstrip("/")
    for d in dates:
        day = batch.where(F.col("detection_date") == F.lit(d)).drop("detection_date")
        (
            day.hint("rebalance", "severity")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("severity")
            .parquet(f"{root}/detection_date={d.isoformat()}")
        )


def read_anomalies(spark: SparkSession, path: str, on_date: Column | dt.date | str | None = None) -> DataFrame:
    """Stored anomalies; ``on_date`` keeps one detection date (pruned at
    listing). Pass ``F.current_date()`` for "today"."""
    df = spark.read.schema(STORED_ANOMALIES).parquet(path).select(*STORED_ANOMALIES.fieldNames())
    if on_date is not None:
        d = on_date if isinstance(on_date, Column) else F.lit(on_date).cast("date")
        df = df.where(F.col("detection_date") == d)
    return df


def newest_first(anomalies: DataFrame) -> DataFrame:
    return anomalies.orderBy(F.col("detected_at").desc(), "crypto_id", "anomaly_type")


# --- retention, daily layout -------------------------------------------------

def retain(df: DataFrame, as_of: Column | dt.date | str, days: int = 30, date_col: str = "collection_date") -> DataFrame:
    """Rows younger than ``days`` days at ``as_of`` (date > as_of - days)."""
    d = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return df.where(F.col(date_col) > F.date_sub(d, days))


def expire_dates(spark: SparkSession, path: str, date_col: str, schema: T.StructType,
                 as_of: dt.date, days: int = 30) -> list[dt.date]:
    """S12 on storage: remove every ``date_col=<d>`` directory that is ``days`` or
    more before ``as_of``, through the file system: one listing, no Spark job.
    ``date_col`` is the table's first partition column. Returns the expired dates."""
    cutoff = as_of - dt.timedelta(days=days)
    found = files.directories(spark, f"{path.rstrip('/')}/{date_col}=*")
    expired = {}
    for directory, (value,) in zip(found, files.values(found, date_col)):
        try:
            day = dt.date.fromisoformat(value)
        except ValueError:  # rows without a date
            continue
        if day <= cutoff:
            expired[directory] = day
    files.remove(spark, expired)
    return sorted(expired.values())


def write_daily(df: DataFrame, root: str, name: str, ts_col: str) -> None:
    """``<root>/<name>/year=YYYY/month=MM/day=DD`` parquet layout. The
    days present in ``df`` are replaced, so a rerun writes the same table."""
    ts = F.timestamp_seconds(F.col(ts_col))
    parted = df.withColumns(
        {"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"), "day": F.date_format(ts, "dd")}
    )
    (
        parted.hint("rebalance", "year", "month", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day")
        .parquet(f"{root.rstrip('/')}/{name}")
    )
