"""Text sources: raw lines and link records."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.fixed_values import FIRST_LINES
from linkmill.operators.edges import parse_edges

#: bytes of small files that are read together
HEAD_BYTES = 16 << 20


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in ``value``; ``path`` may be a glob or a list."""
    return spark.read.text(path)


def read_edges(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "\t",
    comment_prefix: str | None = None,
    mode: str = "failfast",
) -> DataFrame:
    """Link records ``(src, dst)`` from separated text files."""
    return parse_edges(read_lines(spark, path), sep, comment_prefix, mode)


def _groups(sizes: list[tuple[str, int]]) -> Iterator[list[str]]:
    """Consecutive files that together hold no more than HEAD_BYTES; a larger file is alone."""
    held, total = [], 0
    for path, size in sizes:
        if held and total + size > HEAD_BYTES:
            yield held
            held, total = [], 0
        held.append(path)
        total += size
    if held:
        yield held


def first_lines(spark: SparkSession, path: str | list[str], n: int = FIRST_LINES) -> DataFrame:
    """The first ``n`` lines, files in path order and lines in file order.

    Reads heads only: file after file, small files together, until ``n`` lines are
    found.  Of a large file the splits are read in turn, as far as needed, so what is
    read beyond the lines is one split at most.  The ``n`` lines pass the driver.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    sizes = sorted((row["path"], row["length"]) for row in listed.collect())
    found: list[str] = []
    for group in _groups(sizes):
        if len(found) >= n:
            break
        lines = spark.read.text(group)
        if len(group) > 1:
            place = (F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line"))
            lines = lines.select("value", *place).orderBy("_file", "_line")
        found += [row["value"] for row in lines.limit(n - len(found)).collect()]
    return spark.createDataFrame([(line,) for line in found], "value string")
