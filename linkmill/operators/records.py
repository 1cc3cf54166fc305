"""Image records: defaults, boxes and split checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import FLOWER_SPLITS


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace missing values per field; a field that is absent is added."""
    types = dict(df.dtypes)
    filled = {}
    for field, value in defaults.items():
        default = F.lit(value)
        if field in types:
            filled[field] = F.coalesce(F.col(field), default.cast(types[field]))
        else:
            filled[field] = default.cast("long") if isinstance(value, int) else default
    return df.withColumns(filled)


def zip_boxes(df: DataFrame, name: str = "boxes") -> DataFrame:
    """Four coordinate arrays as one array of boxes (ymin, xmin, ymax, xmax)."""
    sides = ("ymin", "xmin", "ymax", "xmax")
    sizes = [F.size(side) for side in sides]
    same = (sizes[0] == sizes[1]) & (sizes[1] == sizes[2]) & (sizes[2] == sizes[3])
    boxes = F.when(same, F.arrays_zip(*sides)).otherwise(
        F.raise_error(F.lit("box coordinates differ in number"))
    )
    return df.withColumn(name, boxes).drop(*sides)


def check_split(df: DataFrame, split: str, sizes: dict[str, int] | None = None) -> DataFrame:
    """Rows of one split, after comparing their number with the declared one."""
    sizes = FLOWER_SPLITS if sizes is None else sizes
    if split not in sizes:
        raise ValueError(f"unknown split {split!r}, expected one of {sorted(sizes)}")
    rows = df.where(F.col("split") == split) if "split" in df.columns else df
    found = rows.count()
    if found != sizes[split]:
        raise ValueError(f"split {split!r} has {found} rows, expected {sizes[split]}")
    return rows
