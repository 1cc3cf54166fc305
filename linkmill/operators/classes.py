"""Class dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import BACKGROUND_NAME
from linkmill.operators.order import content_hash, with_row_index
from linkmill.plans import skew
from linkmill.plans.lineage import materialize
from linkmill.plans.sizes import BROADCAST_BYTES, measured_bytes

#: rows of one key from which on it is sliced
MIN_SLICE_ROWS = 1_000_000

def class_index(files: DataFrame, column: str = "class") -> DataFrame:
    """Sorted distinct class names numbered from 0: ``(label, name)``."""
    names = files.select(F.col(column).alias("name")).distinct()
    return with_row_index(names, "name", name="label").select(F.col("label").cast("int"), "name")


def _looked_up(df: DataFrame, names: DataFrame, key: str, max_bytes: int) -> DataFrame:
    """``df`` with the columns of ``names`` by ``key``, null where there is none.

    A dictionary whose measured bytes allow it is broadcast.  A larger one is joined by
    shuffle: keys that hold too many rows for one task are cut into slices, and
    their one entry is repeated for each.
    """
    if measured_bytes(names) <= max_bytes:
        return df.join(F.broadcast(names), key, "left")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    counts = materialize(counts, "keys")
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    heavy = skew.heavy_keys(counts.where(F.col(key).isNotNull()), key, "_rows", skew.slice_size(total, partitions, MIN_SLICE_ROWS))
    sliced = skew.add_slice(df, key, heavy, content_hash(df))
    return sliced.join(skew.copy_per_slice(names, key, heavy), [key, skew.SLICE], "left").drop(skew.SLICE)


def attach_class_id(
    files: DataFrame, classes: DataFrame, column: str = "class", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``label`` by class name; an unknown class fails the job."""
    names = classes.select(F.col("name").alias(column), F.col("label").alias("_label"))
    complaint = F.concat(F.lit("unknown class: "), F.coalesce(F.col(column), F.lit("null")))
    label = F.coalesce(F.col("_label"), F.raise_error(complaint).cast("int"))
    found = _looked_up(files, names, column, max_bytes)
    return found.select(*files.columns, label.alias("label"))


def with_background(labels: DataFrame) -> DataFrame:
    """Labels moved up by one, with ``(0, 'background')`` in front."""
    spark = labels.sparkSession
    first = spark.range(1).select(F.lit(0).alias("label"), F.lit(BACKGROUND_NAME).alias("name"))
    return first.unionByName(labels.select((F.col("label") + 1).cast("int").alias("label"), "name"))


def label_names(synsets: DataFrame, names: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Names of an ordered id list: ``(label, name)`` with background as 0.

    ``synsets (position, synset)`` is looked up in ``names (synset, name)``;
    an id without a name fails the job.
    """
    lookup = names.select("synset", F.col("name").alias("_name"))
    complaint = F.concat(F.lit("no name for "), F.col("synset"))
    found = F.coalesce(F.col("_name"), F.raise_error(complaint).cast("string"))
    listed = _looked_up(synsets, lookup, "synset", max_bytes).select(
        F.col("position").cast("int").alias("label"), found.alias("name")
    )
    return with_background(listed)
