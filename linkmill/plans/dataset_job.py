"""Image folder to labelled, split and sharded dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.fixed_values import NUM_SHARDS, NUM_VALIDATION, SPLIT_SEED
from linkmill.functions.text import base_name
from linkmill.operators.classes import attach_class_id, class_index
from linkmill.operators.order import assign_shards, seeded_split
from linkmill.sinks.shards import write_shards
from linkmill.sinks.text import write_label_map
from linkmill.sources.images import image_dims, list_image_files, read_images
from linkmill.sources.labels import has_labels, read_label_map


def prepare_image_dataset(
    spark: SparkSession,
    root: str,
    out: str,
    n_validation: int = NUM_VALIDATION,
    shards: int = NUM_SHARDS,
    seed: int = SPLIT_SEED,
    image_format: str = "jpg",
    pixels: bool = False,
) -> DataFrame:
    """Convert ``root/<class>/<file>`` into shards below ``out/records``.

    Classes, split and shards are worked out from the file names alone (``file`` is
    ``<class>/<file>``), so they do not depend on where the folder lies; contents are read
    once and shuffled once.  Height and width come from the encoded bytes of the same row.  With ``pixels`` a record
    holds the decoded RGB pixels in place of the encoded bytes (format ``rgb``), so that
    a split can go straight into ``image_features``.
    A finished dataset is left as it is.  Returns the label dictionary.
    """
    if has_labels(spark, out, "records/_SUCCESS") and has_labels(spark, out):
        return read_label_map(spark, f"{out}/labels.txt")
    named = F.concat_ws("/", "class", base_name(F.col("path"))).alias("file")
    names = list_image_files(spark, root).select("class", named).persist()
    classes = class_index(names).persist()
    listed = seeded_split(names, "file", n_validation, seed)
    if pixels:
        read = read_images(spark, root)
        content, image_format = ["height", "width", "pixels"], "rgb"
    else:
        read = list_image_files(spark, root, content=True)
        content = ["encoded", "_dims.height", "_dims.width"]
    files = seeded_split(read.select("*", named), "file", n_validation, seed, listed=names)
    placed = assign_shards(files, "file", shards, seed=seed, listed=listed)
    labelled = attach_class_id(placed, classes)
    if not pixels:
        labelled = labelled.withColumn("_dims", image_dims(F.col("encoded")))
    write_shards(
        labelled.select(
            "path",
            "file",
            "split",
            "shard",
            F.lit(image_format).alias("format"),
            F.col("label").cast("long").alias("label"),
            *content,
        ),
        f"{out}/records",
        "file",
        shards,
        seed,
    )
    write_label_map(classes, out)
    classes.unpersist()
    names.unpersist()
    return read_label_map(spark, f"{out}/labels.txt")
