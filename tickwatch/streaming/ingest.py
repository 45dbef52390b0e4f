"""Structured Streaming paths (ST1-ST3).

* ST1 :func:`stream_ticks` — envelopes landing under the hourly layout are
  read continuously, flattened (P6) and deduplicated on
  ``(crypto_id, collection_timestamp)`` within an event-time watermark.
  :func:`ingest_sink` does the same per micro-batch and keeps what it does not
  admit (late, duplicate, malformed) in a side table.
* ST2 :func:`price_variation_sink` — the stateless detector (D2) per
  micro-batch into the anomaly table through the idempotent writer (S5+J2),
  so a replayed batch stores nothing twice.
* ST3 :func:`rolling_metrics_sink` — row-frame averages are not available on
  streams, so each micro-batch is joined with the last ``context_rows``
  flat ticks of its keys, a stored state that every batch renews, and the batch windows (W1-W3, chunked) run over
  context + batch; only the batch's rows are kept, filtered (P8), written to
  the metrics table and run through D1/D2.

Both sinks use ``foreachBatch`` with the batch id recorded by the engine's
checkpoint, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch.operators import detect, flatten
from tickwatch.operators.rolling import order_columns
from tickwatch.operators.timecols import add_time_columns
from tickwatch.operators.validity import filter_valid
from tickwatch.plans import transform
from tickwatch.schemas import ENVELOPE, FLAT_TICKS, TICK_COLUMNS
from tickwatch.sources import envelopes, files, tables

# The stored flat-ticks table (partitioned by date; explicit read schema).
_TICKS_STORED = T.StructType(FLAT_TICKS.fields + [T.StructField("collection_date", T.DateType())])


def stream_ticks(spark: SparkSession, raw_root: str, watermark: str = "1 hour", max_files: int | None = None) -> DataFrame:
    """ST1: a streaming DataFrame of flat ticks with ``event_time`` and time
    columns, deduplicated within the watermark."""
    reader = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    env = reader.json(raw_root)
    flat = flatten.explode_and_flatten(env).withColumn(
        "event_time", F.timestamp_seconds("collection_timestamp")
    )
    deduped = flat.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(
        ["crypto_id", "collection_timestamp"]
    )
    return add_time_columns(deduped)


def stream_landed(spark: SparkSession, raw_root: str, max_files: int | None = None) -> DataFrame:
    """Landed lines as a stream, malformed ones included, for :func:`ingest_sink`."""
    reader = spark.readStream.schema(envelopes.LINE).option("recursiveFileLookup", "true").option(
        "columnNameOfCorruptRecord", envelopes.CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.json(raw_root)


def ingest_sink(ticks_path: str, side_path: str, watermark_seconds: int = 3_600, keep_marks: int = 100):
    """ST1 without loss: a ``foreachBatch`` function over :func:`stream_landed`
    that stores every landed row either as a tick or, with the reason, in the side table.

    Reasons: ``malformed`` (a line that is no envelope, kept as it is), ``late``
    (older than the newest tick of earlier batches by more than the watermark) and
    ``duplicate`` (its key and second are stored already or appear earlier in the
    batch, in the order of the other columns). Side rows carry the tick as JSON.

    The newest tick so far is a small state, a row per batch. It is written
    after the batch's side rows and before its ticks, so a replayed batch finds
    its own row, leaves the side rows as they are and stores only the ticks that are missing.
    """
    marks_path = ticks_path.rstrip("/") + "-watermark"
    mark_schema = T.StructType([T.StructField("newest", T.LongType()), T.StructField("batch_id", T.LongType())])
    ident = ["crypto_id", "collection_timestamp"]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lines = batch.persist()
        flat = add_time_columns(flatten.explode_and_flatten(lines.where("metadata IS NOT NULL"))).persist()
        try:
            marks = {}
            if tables.table_exists(spark, marks_path):  # a row for each of the last batches
                marks = {r["batch_id"]: r["newest"] for r in spark.read.schema(mark_schema).parquet(marks_path).collect()}
            before = max((v for b, v in marks.items() if b < batch_id and v is not None), default=None)
            info = flat.agg(F.collect_set("collection_date").alias("dates"), F.max("collection_timestamp").alias("newest")).first()
            late = F.lit(False) if before is None else F.coalesce(F.col("collection_timestamp") < before - watermark_seconds, F.lit(False))
            marked = flat.withColumn("_late", late)
            rest = [F.col(c).asc_nulls_first() for c in TICK_COLUMNS if c not in ident]
            nth = F.row_number().over(Window.partitionBy("_late", *ident).orderBy(*rest))
            ranked = marked.withColumn("_again", ~F.col("_late") & (nth > 1))
            if tables.table_exists(spark, ticks_path):
                stored = spark.read.schema(_TICKS_STORED).parquet(ticks_path).where(F.col("collection_date").isin(info["dates"]))
                held = stored.select(*[F.col(c).alias(f"_{c}") for c in ident]).distinct().withColumn("_held", F.lit(True))
                ranked = ranked.join(held, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ident], "left")
            else:
                ranked = ranked.withColumn("_held", F.lit(None).cast("boolean"))
            again = F.col("_again") | F.coalesce("_held", F.lit(False))
            reason = F.when(F.col("_late"), "late").when(again, "duplicate")
            judged = ranked.withColumn("reason", reason)
            if batch_id not in marks:
                side = judged.where("reason IS NOT NULL").select(
                    "reason", *ident, F.to_json(F.struct(*TICK_COLUMNS)).alias("line"))
                broken = lines.where(F.col("metadata").isNull() & F.col(envelopes.CORRUPT).isNotNull()).select(
                    F.lit("malformed").alias("reason"), F.lit(None).cast("string").alias("crypto_id"),
                    F.lit(None).cast("long").alias("collection_timestamp"), F.col(envelopes.CORRUPT).alias("line"))
                side.unionByName(broken).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(side_path)
                newest = spark.createDataFrame([(info["newest"], batch_id)], mark_schema)
                newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(marks_path)
            write_ticks(judged.where("reason IS NULL"), ticks_path)
            files.remove(spark, [f"{marks_path}/batch_id={b}" for b in sorted(marks) if b < batch_id - keep_marks and marks[b] != before])
        finally:
            flat.unpersist()
            lines.unpersist()

    return run


def write_ticks(batch: DataFrame, ticks_path: str) -> None:
    """Append flat ticks (pre-filter: averages need invalid rows too) by date."""
    cols = list(TICK_COLUMNS) + ["collection_date"]
    (
        batch.select(*cols)
        .hint("rebalance", "collection_date")
        .write.mode("append")
        .partitionBy("collection_date")
        .parquet(ticks_path)
    )


def price_variation_sink(anomalies_path: str, **params):
    """ST2: a ``foreachBatch`` function running D2 and the idempotent S5."""

    def run(batch: DataFrame, batch_id: int) -> None:
        tables.save_anomalies(detect.detect_price_variations(filter_valid(batch), **params), anomalies_path)

    return run


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the whole tick: two readings of one second are two ticks, a replayed row is the same one."""
    named = right.select(*[F.col(c).alias(f"_{c}") for c in TICK_COLUMNS]).distinct()
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in TICK_COLUMNS]
    return left.join(named, on, how)


def _not_stored(batch: DataFrame, spark: SparkSession, path: str, dates: list, metrics: bool = False) -> DataFrame:
    """Rows of ``batch`` that are not yet in the table at ``path`` (only the batch's dates are read)."""
    if not tables.table_exists(spark, path):
        return batch
    table = tables.read_metrics(spark, path) if metrics else spark.read.schema(_TICKS_STORED).parquet(path)
    return _same(batch, table.where(F.col("collection_date").isin(dates)), "left_anti")


#: Directories that the tail's keys are dealt into. A batch touches those of its keys.
TAIL_BUCKETS = 64
_TAIL = T.StructType(FLAT_TICKS.fields + [
    T.StructField("rows", T.LongType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("version", T.LongType()), T.StructField("batch", T.LongType())])


def _newest(rows: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of every key in processing order; a key's rows are cut to ``n`` before they are exchanged."""
    latest = [F.col(c).desc_nulls_last() for c in order_columns(rows.select(*TICK_COLUMNS))]
    rank = F.row_number().over(Window.partitionBy("crypto_id").orderBy(*latest))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("crypto_id"), F.lit(TAIL_BUCKETS)).cast("int")


class Tail:
    """The last ticks of every key, kept beside the stored ticks as ``bucket=/version=/batch=`` directories.

    A batch reads the buckets of its keys and writes their next version, so its
    work depends on its own keys and not on the history. Every row says how
    many rows its key has in that version: a version that was cut off in its
    write does not count, and the one before, which is kept, does. Directories
    also name the batch that wrote them, so a batch replayed any number of times sees the state before it.
    """

    def __init__(self, spark: SparkSession, ticks_path: str, rows: int):
        self.spark, self.path, self.rows = spark, ticks_path.rstrip("/") + "-tail", rows

    def exists(self) -> bool:
        return tables.table_exists(self.spark, self.path)

    def _versions(self, buckets: list[int]) -> DataFrame:
        return self.spark.read.schema(_TAIL).parquet(self.path).where(F.col("bucket").isin(buckets))

    def before(self, batch: int, buckets: list[int]) -> DataFrame:
        """The state of these buckets' keys as it was before ``batch``."""
        found = self._versions(buckets).where(F.col("batch") != batch)
        whole = found.groupBy("crypto_id", "version").agg(F.count("*").alias("n"), F.max("rows").alias("rows")).where("n = rows")
        last = whole.groupBy(F.col("crypto_id").alias("_key")).agg(F.max("version").alias("_version"))
        return found.join(last, F.col("crypto_id").eqNullSafe(F.col("_key")) & (F.col("version") == F.col("_version"))).select(*TICK_COLUMNS)

    def write(self, state: DataFrame, batch: int, buckets: list[int]) -> None:
        """Store the next version of the buckets, then remove what earlier attempts of the batch left and all
        but the newest version of another batch. ``state`` holds every key of the buckets."""
        stored = self._stored(buckets)
        version = 1 + max([-1, *(v for _, v, _ in stored)])
        per_key = Window.partitionBy("crypto_id")
        state.select(*TICK_COLUMNS).withColumns({
            "rows": F.count("*").over(per_key), "bucket": _bucket(), "version": F.lit(version), "batch": F.lit(batch).cast("bigint")}
        ).repartition("bucket").write.mode("append").partitionBy("bucket", "version", "batch").parquet(self.path)
        kept = {b: max(v for c, v, of in stored if c == b and of != batch) for b in {c for c, _, of in stored if of != batch}}
        files.remove(self.spark, [f"{self.path}/bucket={b}/version={v}/batch={of}" for b, v, of in stored if of == batch or v < kept[b]])

    def _stored(self, buckets: list[int]) -> list[tuple[int, int, int]]:
        found = files.directories(self.spark, f"{self.path}/bucket=*/version=*/batch=*")
        named = [tuple(map(int, v)) for v in files.values(found, "bucket", "version", "batch")]
        return [x for x in named if x[0] in set(buckets)]


def _history(spark: SparkSession, ticks_path: str, keys: DataFrame, context_rows: int) -> DataFrame:
    """From the stored ticks: what precedes each key's ticks in the batch. ``keys`` holds ``crypto_id`` and
    ``since`` (its earliest tick). Reads the batch's keys only, cut to the rows needed per key; for ticks older than
    what was processed, and for tables that have no tail yet."""
    stored = spark.read.schema(_TICKS_STORED).parquet(ticks_path).select(*TICK_COLUMNS)
    named = keys.select(F.col("crypto_id").alias("_key"), "since")
    earlier = stored.join(named, F.col("crypto_id").eqNullSafe(F.col("_key")))
    first = _newest(earlier.where("collection_timestamp < since").select(*TICK_COLUMNS), context_rows)
    return first.unionByName(earlier.where("collection_timestamp >= since").select(*TICK_COLUMNS))


def rolling_metrics_sink(
    ticks_path: str,
    metrics_path: str,
    anomalies_path: str,
    context_rows: int = 480,
    chunk_rows: int | None = 16_384,
):
    """ST3: a ``foreachBatch`` function that stores the batch's flat ticks,
    computes W1-W3 with stored context, and writes metrics and anomalies.

    Each write is idempotent (ticks and metrics skip rows already
    stored for the batch's dates, anomalies go through
    the deduplicating sink), so a micro-batch replayed after a failure at
    any point leaves every table as one successful run would.

    ``context_rows`` must cover the longest frame (480 rows before the current
    one). The context is the stored tail of the batch's keys (:class:`Tail`), whatever the cadence and the
    length of the history; other keys are not touched. A batch with ticks that are not newer than its keys'
    tails takes the context of those keys from the stored ticks instead. Metrics of ticks already processed do not
    change: late ticks need a recompute of the affected dates (``tables.write_metrics(..., replace="dates")``).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.select(*TICK_COLUMNS, "collection_date").persist()
        tail, cached = Tail(spark, ticks_path, context_rows), [batch]
        try:
            # One row: bounded by the days of the micro-batch and the buckets; the checksum names the batch.
            info = batch.agg(
                F.collect_set("collection_date").alias("dates"), F.collect_set(_bucket()).alias("buckets"),
                F.bit_xor(F.xxhash64(*TICK_COLUMNS)).alias("mark"), F.count("*").alias("n")).first()
            if not info["n"]:
                return
            dates, buckets, mark = info["dates"], info["buckets"], info["mark"] ^ info["n"]
            own = batch.select(*TICK_COLUMNS)
            keys = own.groupBy("crypto_id").agg(F.min("collection_timestamp").alias("since"))
            context = own.limit(0)
            others = context  # keys of the same buckets that the batch does not hold
            if tail.exists():
                cached.append(state := tail.before(mark, buckets).persist())
                named = keys.select(F.col("crypto_id").alias("_key"), "since")
                of_batch = state.join(named, F.col("crypto_id").eqNullSafe(F.col("_key")))
                others = state.join(named, F.col("crypto_id").eqNullSafe(F.col("_key")), "left_anti")
                late = of_batch.where("collection_timestamp >= since")
                context = of_batch.select(*TICK_COLUMNS)
                if not late.isEmpty():
                    held = late.select(F.col("crypto_id").alias("_held")).distinct()
                    back = keys.join(held, F.col("crypto_id").eqNullSafe(F.col("_held"))).drop("_held")
                    context = context.join(held, F.col("crypto_id").eqNullSafe(F.col("_held")), "left_anti").unionByName(
                        _history(spark, ticks_path, back, context_rows))
            elif tables.table_exists(spark, ticks_path):
                context = _history(spark, ticks_path, keys, context_rows)
            context = _same(context, own, "left_anti")
            marked = own.withColumn("_new", F.lit(True)).unionByName(context.withColumn("_new", F.lit(False)))
            metrics = transform.metrics(marked, chunk_rows=chunk_rows).where("_new").drop("_new")
            fresh = _not_stored(metrics, spark, metrics_path, dates, metrics=True)
            fresh.hint("rebalance", *tables.METRIC_PARTITIONS).write.mode("append").partitionBy(
                *tables.METRIC_PARTITIONS
            ).parquet(metrics_path)
            write_ticks(_not_stored(batch, spark, ticks_path, dates), ticks_path)
            stored_metrics = tables.read_metrics(spark, metrics_path).where(F.col("collection_date").isin(dates))
            tables.save_anomalies(detect.detect_all(_same(stored_metrics, own, "left_semi"), sort=False), anomalies_path)
            tail.write(_newest(own.unionByName(context.select(*TICK_COLUMNS)), context_rows).unionByName(others.select(*TICK_COLUMNS)), mark, buckets)
        finally:
            for df in cached:
                df.unpersist()

    return run


def start(
    stream: DataFrame,
    sink,
    checkpoint: str,
    available_now: bool = False,
    processing_time: str | None = None,
):
    """Start a ``foreachBatch`` query with its own checkpoint location."""
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
