"""Slicing of keys that hold too many rows for one task.

A key with more than ``slice_rows`` rows is cut into ``ceil(rows/slice_rows)``
slices.  At most ``total/slice_rows`` keys can be that large, so the table of
heavy keys stays below ``HEAVY_PER_PARTITION`` rows per partition whatever the
data: that bound is what makes broadcasting it safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_PER_PARTITION = 4
SLICE = "slice"
_SLICES = "_slices"


def slice_size(total_rows: int, partitions: int, floor: int) -> int:
    """Rows per slice: a quarter of a fair share of the table, at least ``floor``."""
    return max(floor, -(-total_rows // (HEAVY_PER_PARTITION * partitions)))


def heavy_keys(counts: DataFrame, key: str, rows: str, slice_rows: int) -> DataFrame:
    """``(key, _slices)`` for the keys whose row count exceeds one slice."""
    return counts.where(F.col(rows) > slice_rows).select(
        key, F.ceil(F.col(rows) / F.lit(slice_rows)).cast("int").alias(_SLICES)
    )


def add_slice(
    df: DataFrame, key: str, heavy: DataFrame, spread: Column, bounded: bool = True
) -> DataFrame:
    """Give every row a slice number; rows of light keys all get slice 0.

    ``spread`` must depend on the row alone, so that a task run again deals out
    its rows as before.  Unless the heavy keys are ``bounded``, they are joined
    by shuffle.
    """
    joined = df.join(F.broadcast(heavy) if bounded else heavy, key, "left")
    number = F.when(F.col(_SLICES).isNull(), F.lit(0)).otherwise(F.pmod(spread, F.col(_SLICES)))
    return joined.withColumn(SLICE, number.cast("int")).drop(_SLICES)


def copy_per_slice(df: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """Repeat the one row of each heavy key once per slice of that key."""
    joined = df.join(F.broadcast(heavy), key, "left")
    last = F.coalesce(F.col(_SLICES), F.lit(1)) - 1
    return joined.withColumn(SLICE, F.explode(F.sequence(F.lit(0), last))).drop(_SLICES)
