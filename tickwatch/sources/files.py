"""Directories of a table, through the path's own Hadoop file system."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tickwatch.session import scratch_path


def _path(spark: SparkSession, path: str):
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no way to the file system
        raise RuntimeError("directories can only be listed and removed from a session with a SparkContext") from None
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def directories(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths of the directories that match a glob pattern, sorted; none where nothing is there."""
    fs, p = _path(spark, pattern)
    found = fs.globStatus(p)
    return sorted(s.getPath().toString() for s in (found or []) if s.isDirectory())


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove directories with all they hold: file system calls only, some at a time, and no Spark job."""
    paths = list(paths)
    if not paths:
        return
    fs, _ = _path(spark, paths[0])
    with ThreadPoolExecutor(min(16, len(paths))) as pool:
        list(pool.map(lambda path: fs.delete(_path(spark, path)[1], True), paths))


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` evaluated once for several readers: written below the shared checkpoint directory, and removed when
    the block ends. Readers take splits of files, whose size is bounded, and only the columns they need; a cached
    partition is as large as whatever one task made, and is read whole. A session without a SparkContext
    cannot remove files and caches instead."""
    spark = df.sparkSession
    try:
        spark.sparkContext
    except Exception:
        df = df.persist()
        try:
            yield df
        finally:
            df.unpersist()
        return
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, [path])


def values(paths: Iterable[str], *columns: str) -> list[tuple[str, ...]]:
    """The values of partition columns in directory paths (``.../name=value/...``)."""
    return [tuple(dict(part.split("=", 1) for part in path.split("/") if "=" in part)[c] for c in columns) for path in paths]


#: A writer renews its claim this often, and a claim not renewed for this long counts as left behind (seconds).
RENEWED, LEFT = 20.0, 180.0


def _create(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless there is one: a single atomic step of the file system."""
    fs, p = _path(spark, path)
    if fs.getUri().getScheme() == "file":  # the local file system's own create looks first and writes then
        fs.mkdirs(p.getParent())
        return spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).createNewFile()
    try:
        fs.create(p, False).close()
    except Exception as exc:  # a Py4J error around the Java one
        if "AlreadyExists" in str(exc):
            return False
        raise
    return True


@contextmanager
def sole_writer(spark: SparkSession, table_path: str, wait: float = 3_600.0) -> Iterator[None]:
    """Hold the claim ``<table_path>-writer`` while the block runs; other writers wait for it.

    The holder renews the claim's time. One that was not renewed for :data:`LEFT`
    seconds, because its driver died, is moved away by whoever waits; only one
    can move it, and the next creation decides again. Needs a file system whose
    creation without overwriting is atomic (HDFS, local, object stores with conditional writes). A session
    without a SparkContext has no way to claim and must be the only writer.
    """
    claim = f"{table_path.rstrip('/')}-writer"
    try:
        fs, p = _path(spark, claim)
    except RuntimeError:
        yield
        return
    until, pause = time.monotonic() + wait, 0.1
    while not _create(spark, claim):
        try:
            age = time.time() - fs.getFileStatus(p).getModificationTime() / 1000
        except Exception:  # released just now
            continue
        if age > LEFT:
            fs.rename(p, _path(spark, f"{claim}-left-{uuid.uuid4().hex[:8]}")[1])
            continue
        if time.monotonic() > until:
            raise TimeoutError(f"another writer holds {claim}")
        time.sleep(pause)
        pause = min(2.0, pause * 1.5)
    over = threading.Event()

    def renew() -> None:
        while not over.wait(RENEWED):
            fs.setTimes(p, int(time.time() * 1000), -1)

    threading.Thread(target=renew, daemon=True).start()
    try:
        yield
    finally:
        over.set()
        fs.delete(p, False)
