from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickwatch.schemas import FLAT_TICKS  # noqa: E402
from tickwatch.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tickwatch-test-ckpt-")
    s = build_session(
        "local[*]",
        app_name="tickwatch-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tickwatch-test-")


def tick(ts, key="bitcoin", price=100.0, volume=1000.0, change=0.0, seq=None, brl=None):
    """One flat tick row (tuple in FLAT_TICKS order, optional seq)."""
    row = (ts, key, price, brl if brl is not None else (None if price is None else price * 5), volume, change, ts - 60, ts)
    return row if seq is None else row + (seq,)


def ticks_df(spark, rows, with_seq=False):
    from pyspark.sql import types as T

    schema = FLAT_TICKS
    if with_seq:
        schema = T.StructType(FLAT_TICKS.fields + [T.StructField("seq", T.LongType())])
    return spark.createDataFrame(rows, schema)
