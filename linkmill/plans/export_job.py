"""CSV to ordered CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.fixed_values import EXPORT_ORDER, EXPORT_VIEW
from linkmill.operators.order import stable_order
from linkmill.sinks.text import write_export
from linkmill.sources.tables import read_export


def sort_export(df: DataFrame, by: tuple[str, ...] = EXPORT_ORDER, as_text: bool = True) -> DataFrame:
    """All columns in total order of the text columns ``by``, nulls first.

    With ``as_text=False`` the last column is compared as a number;
    what is no number counts as null.
    """
    if as_text:
        return stable_order(df, *by)
    return stable_order(df, *by[:-1], F.col(by[-1]).try_cast("double"))


def export_view(df: DataFrame, by: tuple[str, ...] = EXPORT_ORDER) -> DataFrame:
    """The same order through SQL over the global temporary view, ties broken as in ``stable_order``."""
    df.createOrReplaceGlobalTempView(EXPORT_VIEW)
    order = ", ".join(f"`{c}`" for c in by)
    cells = ", ".join(f"`{c}`" for c in df.columns)
    return df.sparkSession.sql(
        f"""SELECT * EXCEPT (_content, _tie) FROM (
              SELECT *, monotonically_increasing_id() AS _tie FROM (
                SELECT *, xxhash64({cells}) AS _content FROM global_temp.{EXPORT_VIEW} SORT BY _content)
              ORDER BY {order}, _content, _tie)"""
    )


def sort_export_job(
    spark: SparkSession,
    src: str,
    out: str,
    by: tuple[str, ...] = EXPORT_ORDER,
    single_file: bool = False,
) -> None:
    """Read a headed CSV, order it by ``by``, write it as CSV without header."""
    write_export(read_export(spark, src), out, *by, single_file=single_file)
