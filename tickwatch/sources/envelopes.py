"""Landed collection envelopes: scan (S1), quarantine (S1b), landing (S3).

Layout: ``<root>/year=YYYY/month=MM/day=DD/hour=HH/*.json``, one JSON object
per line, UTC. Reading from the root (not a ``*/*/*/*/*`` glob) keeps the
hive partition columns, so filters on them prune directories before any
file is opened. They are declared as strings in the read schema, so ``05``
stays ``05``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.operators.timecols import landing_columns
from tickwatch.schemas import ENVELOPE
from tickwatch.sources import files

PARTITIONS = ("year", "month", "day", "hour")
CORRUPT = "_corrupt_record"

# A landed line: an envelope, or its text if it is none.
LINE = T.StructType(ENVELOPE.fields + [T.StructField(CORRUPT, T.StringType())])
_READ_SCHEMA = T.StructType(LINE.fields + [T.StructField(p, T.StringType()) for p in PARTITIONS])


def read_envelopes_raw(spark: SparkSession, root: str, multiline: bool = False) -> DataFrame:
    """All columns: ``metadata``, ``data``, ``_corrupt_record`` and the
    partition columns. Malformed lines are kept (permissive mode) with only
    ``_corrupt_record`` set. ``multiline=True`` reads pretty-printed files
    (one document per file; such files are not split across tasks)."""
    reader = (
        spark.read.schema(_READ_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("basePath", root)
    )
    if multiline:
        reader = reader.option("multiLine", "true")
    return reader.json(root)


def read_envelopes(
    spark: SparkSession,
    root: str,
    where: Column | None = None,
    keep_partitions: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Well-formed envelopes under ``root``.

    ``where`` may filter on ``year/month/day/hour`` (pruned at listing time).
    Malformed lines are excluded here; see :func:`quarantine`.
    """
    df = read_envelopes_raw(spark, root, multiline)
    if where is not None:
        df = df.where(where)
    # Malformed lines have every data column null; naming ``metadata`` in the
    # predicate also keeps a data column in the scan (Spark rejects scans of
    # raw JSON that would read only the corrupt-record column).
    df = df.where(F.col(CORRUPT).isNull() | F.col("metadata").isNotNull())
    cols = ["metadata", "data"] + (list(PARTITIONS) if keep_partitions else [])
    return df.select(*cols)


def quarantine(spark: SparkSession, root: str, where: Column | None = None) -> DataFrame:
    """Malformed lines with their partition values, for a quarantine table."""
    df = read_envelopes_raw(spark, root)
    if where is not None:
        df = df.where(where)
    bad = F.col(CORRUPT).isNotNull() & F.col("metadata").isNull()
    return df.where(bad).select(F.col(CORRUPT).alias("raw_line"), *PARTITIONS)


def partition_range(start_ts: int, end_ts: int) -> Column:
    """A directory-pruning predicate covering UTC hours ``[start, end]`` given
    as epoch seconds (compares the zero-padded ``yyyyMMddHH`` text)."""
    import datetime as dt

    fmt = lambda t: dt.datetime.fromtimestamp(t, dt.timezone.utc).strftime("%Y%m%d%H")
    key = F.concat(*[F.col(p) for p in PARTITIONS])
    return (key >= F.lit(fmt(start_ts))) & (key <= F.lit(fmt(end_ts)))


def land_envelopes(envelopes: DataFrame, root: str) -> None:
    """S3: append envelopes as JSON lines under the hourly layout (UTC).

    Rows are rebalanced by hour directory first so each hour gets few files;
    AQE splits an oversized hour instead of sending it to one task. Spark
    names the files; the logical per-collection object name is available
    from :func:`tickwatch.operators.timecols.landing_key`.
    """
    parted = landing_columns(
        envelopes.withColumn("_ts", F.col("metadata.collectionTimestamp")), "_ts"
    ).drop("_ts", "file_name")
    (
        parted.hint("rebalance", *PARTITIONS)
        .write.mode("append")
        .partitionBy(*PARTITIONS)
        .json(root)
    )


def expire_raw(spark: SparkSession, root: str, as_of, days: int = 30) -> list[str]:
    """S12 on the landing layout: remove every day directory that is ``days`` or
    more before ``as_of`` (a ``datetime.date``), through the file system: one
    listing of days, no Spark job. Returns the expired days as ``yyyy-MM-dd`` strings.
    """
    import datetime as dt

    cutoff = (as_of - dt.timedelta(days=days)).isoformat()
    found = files.directories(spark, f"{root.rstrip('/')}/year=*/month=*/day=*")
    expired = {d: "-".join(v) for d, v in zip(found, files.values(found, "year", "month", "day")) if "-".join(v) <= cutoff}
    files.remove(spark, expired)
    return sorted(expired.values())
