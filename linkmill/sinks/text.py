"""Text and CSV sinks.

All fail when the target exists.  Ordered output is written as part files
whose name order is the row order; one single file, through one task, is the
caller's explicit choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import LABELS_FILE
from linkmill.functions.text import label_line
from linkmill.operators.order import stable_order


def write_ranks_text(ranks: DataFrame, path: str, as_tuple: bool = False) -> None:
    """``node<TAB>rank`` lines, or one tuple literal per line."""
    if as_tuple:
        line = F.format_string("('%s', %s)", F.col("node"), F.col("rank").cast("string"))
    else:
        line = F.concat_ws("\t", F.col("node"), F.col("rank").cast("string"))
    ranks.select(line.alias("value")).write.mode("errorifexists").text(path)


def write_ranks_csv(ranks: DataFrame, path: str, single_file: bool = False) -> None:
    """``node,rank`` without header; nothing passes through the driver."""
    out = ranks.repartition(1) if single_file else ranks
    out.write.mode("errorifexists").csv(path)


def write_export(
    df: DataFrame,
    path: str,
    *order: str | Column,
    single_file: bool = False,
) -> None:
    """CSV without header in the given order.

    Part files are range-partitioned: read in name order they are the sorted
    table.  ``single_file`` gives one part, sorted by one task.
    """
    if single_file:
        out = df.repartition(1).sortWithinPartitions(*order)
    else:
        out = stable_order(df, *order)
    out.write.mode("errorifexists").csv(path)


def write_label_map(labels: DataFrame, folder: str, filename: str = LABELS_FILE) -> None:
    """``label:name`` lines in label order."""
    lines = labels.orderBy("label").select(label_line(F.col("label"), F.col("name")).alias("value"))
    lines.write.mode("errorifexists").text(f"{folder.rstrip('/')}/{filename}")


def write_trace(trace: DataFrame, path: str, form: str = "parquet") -> None:
    """Per-step loss, accuracy and speed."""
    trace.write.mode("errorifexists").format(form).save(path)
