"""Helpers shared by the text operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.session import scratch_path

#: A word is a run of characters other than the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"


def text_or_empty(col: Column | str) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(col: Column | str) -> Column:
    """Array of the words of a text (null: none)."""
    return F.array_remove(F.split(text_or_empty(col), SPACES, -1), "")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, names: list[str]) -> list[Column]:
    """The columns of ``df`` except ``names``: an operator's output columns
    replace input columns of the same name (case-insensitively, as Spark resolves them)."""
    drop = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in drop]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint directory and read it back: a
    lineage cut that survives lost executors, and one evaluation for several readers."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_code() -> None:
    """Pickle this package by value, so Python workers need no installation."""
    from pyspark import cloudpickle

    import tickwatch

    cloudpickle.register_pickle_by_value(tickwatch)


def worker_cache(key: Hashable, build: Callable[[], Any]) -> Any:
    """One object per Python worker process, kept between its tasks.

    Shipped functions get fresh globals in every task, so the cache hangs on
    the ``sys`` module, which the whole process shares.
    """
    cache = sys.__dict__.setdefault("_tickwatch_worker_cache", {})
    if key not in cache:
        cache[key] = build()
    return cache[key]
