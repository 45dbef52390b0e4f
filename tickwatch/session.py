"""Session defaults and the shared scratch location.

Jobs never pick a machine-local folder themselves: lineage cuts and scratch
tables go under ``spark.checkpoint.dir``, which a cluster points at shared
storage. Only when it is unset (local tests, the bench) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so derived dates/hours match the UTC
# landing layout, AQE so joins against small derived tables become broadcasts
# only after their size has been measured, and skewed shuffle partitions of a
# hot key get split.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Small shuffles (a batch of a few MB written into hourly directories)
    # keep their parallelism instead of collapsing into one task; large ones
    # are sized by the advisory partition size as usual.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tickwatch",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with :data:`SESSION_DEFAULTS` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # Reliable checkpoints (the row-frame bucket plans) are removed once the
    # DataFrames using them are garbage collected.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():  # a reused session gets the runtime settings too
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf of an already running context
            pass
    return spark


# Settings results depend on (dates and hours are UTC, like the landing
# layout). Applied to any session handed to us; performance settings are
# left to whoever built the session.
SEMANTIC_SETTINGS = {"spark.sql.session.timeZone": "UTC"}


def apply_defaults(spark: SparkSession) -> None:
    """Apply the settings results depend on to an existing session."""
    for k, v in SEMANTIC_SETTINGS.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared scratch root: the session's ``spark.checkpoint.dir``.

    Only a local session without one (tests, the bench) gets a fresh
    temporary directory; on a cluster a machine-local folder would not be
    shared with the executors, so an unset directory is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint directory
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server") from None
        return root
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError(
                    "set spark.checkpoint.dir to a shared location (e.g. an object-store path) for this cluster"
                )
            root = tempfile.mkdtemp(prefix="tickwatch-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use the path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
