"""Label dictionaries kept as text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.fixed_values import LABELS_FILE, SYNSET_COUNT, SYNSET_NAME_COUNT
from linkmill.functions.text import after_first, before_first
from linkmill.operators.classes import label_names
from linkmill.operators.order import with_row_index


def parse_label_lines(lines: DataFrame) -> DataFrame:
    """``(label, name)`` from ``label:name`` lines; blank lines are skipped.

    The name may itself contain colons.
    """
    value = F.col("value")
    filled = lines.where(F.length(value) > 0)
    return filled.select(
        before_first(value, ":").cast("int").alias("label"), after_first(value, ":").alias("name")
    )


def has_labels(spark: SparkSession, folder: str, filename: str = LABELS_FILE) -> bool:
    """Whether the folder holds a label file."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{filename}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """``(label, name)`` from a label file."""
    return parse_label_lines(spark.read.text(path))


def _checked(df: DataFrame, expected: int | None, what: str) -> DataFrame:
    if expected is not None and (found := df.count()) != expected:
        raise ValueError(f"{what}: {found} rows, expected {expected}")
    return df


def number_synsets(lines: DataFrame, *order: str) -> DataFrame:
    """``(position, synset)`` of id lines in the given order, from 0."""
    ids = lines.withColumn("synset", F.trim("value"))
    return with_row_index(ids, *order, name="position").select("position", "synset")


def parse_synset_names(lines: DataFrame) -> DataFrame:
    """``(synset, name)`` from two tab-separated fields per line."""
    fields = F.split(F.trim(F.col("value")), "\t")
    complaint = F.concat(F.lit("expected two fields: "), F.col("value"))
    checked = F.when(F.size(fields) == 2, fields).otherwise(
        F.raise_error(complaint).cast("array<string>")
    )
    return lines.select(checked.alias("f")).select(
        F.get("f", F.lit(0)).alias("synset"), F.get("f", F.lit(1)).alias("name")
    )


def read_synset_names(
    spark: SparkSession,
    synsets: str,
    names: str,
    n_synsets: int | None = SYNSET_COUNT,
    n_names: int | None = SYNSET_NAME_COUNT,
) -> DataFrame:
    """Label dictionary of an ordered id list and an id-to-name table.

    The list's files count in name order, their lines in file order.
    """
    listed = _checked(spark.read.text(synsets), n_synsets, "synset list").select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    ids = number_synsets(listed, "_file", "_block", "_line")
    named = _checked(spark.read.text(names), n_names, "synset names")
    return label_names(ids, parse_synset_names(named))
