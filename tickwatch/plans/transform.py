"""The transform stage as one lazy plan: flat ticks -> metrics table.

``ticks -> time columns (P7) -> moving averages (W1-W3) -> validity (P8)``.
The averages are computed before the validity filter (zeros and negatives
count, nulls are skipped); Catalyst may still push ``crypto_id IS NOT NULL``
below the window because it is on the partition key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickwatch.operators.rolling import DEFAULT_CHUNK_ROWS, add_moving_averages
from tickwatch.operators.timecols import add_time_columns
from tickwatch.operators.validity import filter_valid
from tickwatch.schemas import TIME_COLUMNS

TIME_COLUMN_NAMES = [f.name for f in TIME_COLUMNS.fields]


def with_averages(
    ticks: DataFrame, chunk_rows: int | None = DEFAULT_CHUNK_ROWS, with_counts: bool = False
) -> DataFrame:
    """P7 + W1-W3 on all rows (before the validity filter).

    The time columns are a per-row projection, so they are added after the
    window exchanges instead of being shuffled twice."""
    averaged = add_moving_averages(ticks, chunk_rows=chunk_rows, with_counts=with_counts, blocks=True)
    ma_cols = [c for c in averaged.columns if c not in ticks.columns]
    return add_time_columns(averaged).select(*ticks.columns, *TIME_COLUMN_NAMES, *ma_cols)


def metrics(
    ticks: DataFrame, chunk_rows: int | None = DEFAULT_CHUNK_ROWS, with_counts: bool = False
) -> DataFrame:
    """The metrics table: valid rows with time columns and moving averages
    (``with_counts`` adds the readings per frame, e.g. ``volume_ma_24h_n``)."""
    return filter_valid(with_averages(ticks, chunk_rows=chunk_rows, with_counts=with_counts))
