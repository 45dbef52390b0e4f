"""Alerts: anomaly rows -> alert records -> subject/body text -> delivery.

Nothing is collected to the driver. Text is built with Catalyst string
functions; delivery runs inside executors through ``mapInPandas`` with a
pluggable ``send`` function. A task retry may call ``send`` again for the
same alert, so delivery is at-least-once: every alert carries a stable
``alert_key``, made of what makes an anomaly the same (key, type, detection
time, reading), that receivers can deduplicate on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import ExitStack

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.functions.columns import double_text, epoch_text
from tickwatch.schemas import ALERTS, DELIVERY_RESULT, OUTBOX
from tickwatch.sources.files import staged
from tickwatch.sources.tables import ANOMALY_KEY, table_exists, with_detection_date

# Alert text.
RULE = "═" * 55
TITLE = "CRYPTO ANOMALY ALERT"
FOOTER = "This is an automated alert from Crypto Anomaly Detection System"
SUBJECT_MIDDLE = " Crypto Alert: "
SEVERITY_MARK = {"high": "HIGH", "medium": "MEDIUM"}  # anything else: "_"
LABEL_KEY = "Cryptocurrency: "
LABEL_TYPE = "Anomaly Type:   "
LABEL_SEVERITY = "Severity:       "
LABEL_PRICE = "Current Price:  $"
LABEL_VARIATION = "Variation:      "
LABEL_DESCRIPTION = "Description:    "
LABEL_DETECTED_AT = "Detected At:    "
TRAILER = " " * 7  # the body ends with a newline and seven spaces


def to_alerts(anomalies: DataFrame) -> DataFrame:
    """P10: the alert record (drops ``reference_value``)."""
    return anomalies.select(*[f.name for f in ALERTS.fields])


def alert_key() -> Column:
    """The identity of the anomaly table as text, so two readings of one second are two alerts."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in ANOMALY_KEY])


def subject() -> Column:
    """``HIGH|MEDIUM|_`` + `` Crypto Alert: `` + upper key + `` - `` + type."""
    sev = F.col("severity")
    mark = F.when(sev == "high", F.lit(SEVERITY_MARK["high"])).when(
        sev == "medium", F.lit(SEVERITY_MARK["medium"])
    ).otherwise(F.lit("_"))
    return F.concat(mark, F.lit(SUBJECT_MIDDLE), F.upper("crypto_id"), F.lit(" - "), F.col("anomaly_type"))


def body() -> Column:
    """The fixed multi-line message. Numbers print the JVM way
    (``70956.0``, ``4.0E10``); the time is the detection time in UTC."""
    lines = [
        F.lit(""),
        F.lit(RULE),
        F.lit(TITLE),
        F.lit(RULE),
        F.lit(""),
        F.concat(F.lit(LABEL_KEY), F.upper("crypto_id")),
        F.concat(F.lit(LABEL_TYPE), F.col("anomaly_type")),
        F.concat(F.lit(LABEL_SEVERITY), F.upper("severity")),
        F.lit(""),
        F.concat(F.lit(LABEL_PRICE), double_text("current_price")),
        F.concat(F.lit(LABEL_VARIATION), double_text("variation_pct"), F.lit("%")),
        F.lit(""),
        F.concat(F.lit(LABEL_DESCRIPTION), F.col("description")),
        F.lit(""),
        F.concat(F.lit(LABEL_DETECTED_AT), epoch_text("detected_at"), F.lit(" UTC")),
        F.lit(""),
        F.lit(RULE),
        F.lit(FOOTER),
        F.lit(RULE),
        F.lit(TRAILER),
    ]
    return F.concat_ws("\n", *lines)


def with_text(alerts: DataFrame) -> DataFrame:
    """Adds ``alert_key``, ``subject`` and ``message``."""
    return alerts.withColumns({"alert_key": alert_key(), "subject": subject(), "message": body()})


Send = Callable[[str, str, str], str]


def outbox_send(key: str, subject_text: str, message: str) -> str:
    """A sender that sends nothing: the message id is derived from the alert
    key, as :func:`deliver` does without a sender."""
    import hashlib

    return "outbox-" + hashlib.sha1(key.encode("utf-8")).hexdigest()[:16]


def _pickle_package_by_value() -> None:
    """Ship this package's code inside the serialized task function, so the
    executors' Python workers need not have ``tickwatch`` installed or on
    their path (functions of importable modules are otherwise pickled by
    reference)."""
    import tickwatch
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(tickwatch)


def deliver(alerts_text: DataFrame, send: Send | None = None) -> DataFrame:
    """Call ``send(alert_key, subject, message)`` for every alert inside
    the executors; one failure never stops the rest. Without ``send`` alerts
    are only recorded. Returns one row per alert: ``alert_key, subject,
    detected_at, ok, message_id, error``. Every action on the result delivers:
    write it once, as :func:`deliver_pending` does."""
    if send is None:
        return alerts_text.select(
            "alert_key",
            "subject",
            "detected_at",
            F.lit(True).alias("ok"),
            F.concat(F.lit("outbox-"), F.left(F.sha1(F.col("alert_key").cast("binary")), F.lit(16))).alias("message_id"),
            F.lit(None).cast("string").alias("error"),
        )
    _pickle_package_by_value()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = {"ok": [], "message_id": [], "error": []}
            for key, subj, msg in zip(pdf["alert_key"], pdf["subject"], pdf["message"]):
                try:
                    mid = send(key, subj, msg)
                    out["ok"].append(True)
                    out["message_id"].append(mid)
                    out["error"].append(None)
                except Exception as exc:  # noqa: BLE001 - delivery errors are data
                    out["ok"].append(False)
                    out["message_id"].append(None)
                    out["error"].append(f"{type(exc).__name__}: {exc}")
            yield pd.concat([pdf[["alert_key", "subject", "detected_at"]], pd.DataFrame(out)], axis=1)

    return alerts_text.select("alert_key", "subject", "detected_at", "message").mapInPandas(run, DELIVERY_RESULT)


def outbox(spark: SparkSession, outbox_path: str, dates: list | None = None) -> DataFrame:
    """The attempts in the outbox table; with ``dates``, only those detection dates' directories are read."""
    attempts = spark.read.schema(OUTBOX).parquet(outbox_path)
    if dates is None:
        return attempts
    known = F.col("detection_date").isin([d for d in dates if d is not None])
    return attempts.where(known | F.col("detection_date").isNull() if None in dates else known)


def deliver_pending(anomalies: DataFrame, outbox_path: str, send: Send | None = None) -> DataFrame:
    """Deliver the alerts of ``anomalies`` that the outbox table does not hold
    as delivered, newest first, and append the attempts to it. Returns this
    run's attempts, read back from the table, so later actions deliver
    nothing. A run that stops
    between delivery and the end of its write repeats its alerts
    (at-least-once); a failed attempt is tried again by the next run.

    The outbox is partitioned by detection date and only the dates of the batch
    (a short list) are read. The batch is then staged for the dates and the delivery, without texts: only what is
    pending gets its subject and message, after it was ordered."""
    spark = anomalies.sparkSession
    batch = with_detection_date(to_alerts(anomalies))
    dates = None
    with ExitStack() as stack:
        if known := table_exists(spark, outbox_path):
            batch = stack.enter_context(staged(batch, "alerts-batch"))
        pending = batch.withColumn("alert_key", alert_key())
        if known:
            dates = [r[0] for r in batch.select("detection_date").distinct().collect()]
            done = outbox(spark, outbox_path, dates).where("ok").select(
                F.col("detection_date").alias("_date"), F.col("alert_key").alias("_key")).distinct()
            pending = pending.join(done, F.col("detection_date").eqNullSafe(F.col("_date")) & (F.col("alert_key") == F.col("_key")), "left_anti")
        run_id = uuid.uuid4().hex
        text = with_text(pending.orderBy(F.col("detected_at").desc(), "alert_key"))
        attempts = deliver(text, send).withColumn("run_id", F.lit(run_id))
        with_detection_date(attempts).select(*OUTBOX.fieldNames()).write.mode("append").partitionBy("detection_date").parquet(outbox_path)
    return outbox(spark, outbox_path, dates).where(F.col("run_id") == run_id)


def sent_alerts(spark: SparkSession, outbox_path: str) -> DataFrame:
    """The delivered alerts, newest first."""
    return outbox(spark, outbox_path).where("ok").orderBy(F.col("detected_at").desc(), "alert_key")


def tally(results: DataFrame) -> DataFrame:
    """One row ``(succeeded, failed)`` over the delivery results."""
    return results.agg(
        F.count_if(F.col("ok")).alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
    )
