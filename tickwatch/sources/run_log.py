"""Run log: append a run record (S8), import the text form.

The log is a parquet table with a real boolean ``success`` column, so an
error message with commas or newlines cannot corrupt other fields. The CSV
form is read only for import, with every field as text and then the
lenient parse of :func:`tickwatch.plans.reports.parse_run_log`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwatch.plans.reports import parse_run_log
from tickwatch.schemas import RUN_LOG, RUN_LOG_COLUMNS, RUN_LOG_STRINGS


def append_run(record: DataFrame, path: str) -> None:
    """Append run record(s) (normally one row) to the log."""
    record.select(*RUN_LOG_COLUMNS).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the text of every CSV record below ``path``, with its newlines, from files read in splits.

    Whether a line begins a record depends on the number of quotes before it in
    the file. A split counts its quotes, and the records that begin in it
    for either parity at its start; prefix sums over a file's splits then give the
    parity and the first record number of each, and every line its record. Lines of a
    record meet again by that number, which a record cut by a split needs.
    """
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, line, quotes, begun = None, 0, 0, [0, 0]
        for batch in batches:
            file, block, text = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for f, b, t in zip(file, block, text):
                if split != (f, b):
                    split, line, quotes, begun = (f, b), 0, 0, [0, 0]
                begun[quotes % 2] += 1  # at an even number of quotes in the file, a record begins
                out.append((line, quotes, *begun))
                quotes, line = quotes + t.count('"'), line + 1
                out[-1] += (quotes,)
            numbers = [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], names=["file", "block", "value", "line", "before", "even", "odd", "after"])

    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    placed = lines.mapInArrow(
        places, "file string, block bigint, value string, line bigint, before bigint, even bigint, odd bigint, after bigint")
    # A row for each split of a file.
    splits = placed.groupBy("file", "block").agg(F.max("even").alias("even"), F.max("odd").alias("odd"), F.max("after").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("parity", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    splits = splits.withColumn("first", F.coalesce(F.sum(F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd"))).over(earlier), F.lit(0)))
    numbered = placed.drop("after").join(splits.select("file", "block", "parity", "first"), ["file", "block"]).withColumn(
        "record", F.col("first") + F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd")))
    parts = numbered.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
    return parts.select(F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["value"]), "\n"), "\r$", "").alias("record"))


def read_run_log_csv(spark: SparkSession, path: str, quoted_newlines: bool = True) -> DataFrame:
    """CSV with a header; quoted fields may hold commas, quotes and
    newlines. Files are read in splits either way; logs known to have no newline in
    a field are read in one pass with ``quoted_newlines=False``."""
    options = {"escape": '"', "mode": "PERMISSIVE"}
    if not quoted_newlines:
        return parse_run_log(spark.read.schema(RUN_LOG_STRINGS).options(header="true", **options).csv(path))
    header = ",".join(RUN_LOG_COLUMNS)
    records = _records(spark, path).where((F.col("record") != "") & (F.col("record") != header))
    fields = ", ".join(f"`{f.name}` string" for f in RUN_LOG_STRINGS.fields)
    return parse_run_log(records.select(F.from_csv("record", fields, options).alias("r")).select("r.*"))


def write_run_log_csv(run_log: DataFrame, path: str) -> None:
    """The text form, for tools that want CSV (quoted where needed)."""
    run_log.select(*RUN_LOG_COLUMNS).write.mode("overwrite").option("header", "true").option(
        "escape", '"'
    ).csv(path)
