"""Tabular sources: exports, labelled vectors, image records, generated rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.fixed_values import (
    FLOWER_CLASSES,
    FLOWER_DEFAULTS,
    FLOWER_PATTERN,
    FLOWER_SPLITS,
    LABELS_FILE,
    SYNSET_CLASSES,
    SYNSET_DEFAULTS,
    SYNSET_PATTERN,
    SYNSET_SPLITS,
    SYNTHETIC_CLASSES,
)
from linkmill.operators.records import with_defaults, zip_boxes
from linkmill.sinks.shards import SHARD_FILE
from linkmill.sources.labels import has_labels, read_label_map


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column stays text."""
    return spark.read.csv(path, header=True)


def read_feature_table(
    spark: SparkSession, path: str, features: str = "features", label: str = "label"
) -> DataFrame:
    """Labelled vectors as ``(features array<float>, label int)``."""
    rows = spark.read.parquet(path)
    return rows.select(
        F.col(features).cast("array<float>").alias("features"), F.col(label).cast("int").alias("label")
    )


def _uniform(seed: int, key: Column, what: str) -> Column:
    """A number in (0, 1) that hangs on its arguments alone: 32 bits of an MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), key.cast("string"), F.lit(what))
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 32)


def with_synthetic_features(
    ids: DataFrame,
    dim: int,
    classes: int = SYNTHETIC_CLASSES,
    seed: int = 0,
    repeat_one: bool = False,
    key: str = "id",
) -> DataFrame:
    """Add normal ``features`` and a uniform ``label`` to each row of ``ids``.

    Both are formulas over ``seed`` and the row's ``key`` (Box-Muller over two hashed uniforms), so the
    same id has the same values in every run and layout.  ``repeat_one`` gives
    every row those of key 0.
    """
    of = F.lit(0) if repeat_one else F.col(key)

    def normal(i: int) -> Column:
        radius = F.sqrt(F.lit(-2.0) * F.log(_uniform(seed, of, f"r{i}")))
        return radius * F.cos(F.lit(2 * math.pi) * _uniform(seed, of, f"a{i}"))

    features = F.array(*[normal(i) for i in range(dim)]).cast("array<float>")
    label = F.floor(_uniform(seed, of, "label") * classes).cast("int")
    return ids.withColumns({"features": features, "label": label})


def synthetic_features(
    spark: SparkSession,
    n: int,
    dim: int,
    num_classes: int = SYNTHETIC_CLASSES,
    seed: int = 0,
    repeat_one: bool = False,
) -> DataFrame:
    """``n`` generated rows ``(id, features, label)``."""
    return with_synthetic_features(spark.range(n), dim, num_classes, seed, repeat_one)


# layouts of image datasets: splits, file name pattern, field defaults, classes
LAYOUTS = {
    "flowers": (FLOWER_SPLITS, FLOWER_PATTERN, FLOWER_DEFAULTS, FLOWER_CLASSES),
    "synsets": (SYNSET_SPLITS, SYNSET_PATTERN, SYNSET_DEFAULTS, SYNSET_CLASSES),
}


@dataclass(frozen=True)
class DatasetInfo:
    """What is declared about one split of an image dataset."""

    pattern: str
    rows: int
    classes: int
    labels: DataFrame | None


def describe_split(spark: SparkSession, path: str, split: str, layout: str = "flowers") -> DatasetInfo:
    """Declared shard pattern, row and class count, and the label names if the folder has them."""
    splits, pattern, _, classes = LAYOUTS[layout]
    if split not in splits:
        raise ValueError(f"unknown split {split!r}, expected one of {sorted(splits)}")
    labels = read_label_map(spark, f"{path}/{LABELS_FILE}") if has_labels(spark, path) else None
    return DatasetInfo(pattern % split, splits[split], classes, labels)


def read_image_records(
    spark: SparkSession, path: str, split: str, layout: str = "flowers"
) -> DataFrame:
    """Records of one split, missing fields filled with their defaults.

    Shards are picked by the split's name pattern on the shard folders, so
    shards of other splits are not opened.
    """
    splits, pattern, defaults, _ = LAYOUTS[layout]
    if split not in splits:
        raise ValueError(f"unknown split {split!r}, expected one of {sorted(splits)}")
    named = F.startswith(F.col(SHARD_FILE), F.lit((pattern % split).rstrip("*")))
    records = with_defaults(spark.read.parquet(path).where(named), defaults)
    boxes = {"xmin", "ymin", "xmax", "ymax"}
    return zip_boxes(records) if boxes <= set(records.columns) else records


def spread_small(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer splits than the session has slots.

    A large input has more splits than slots and is returned unchanged.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
