"""Exact duplicates by a tree-merge of sorted digest runs.

Rows are dealt into runs by their id.  A run is first reduced to one entry per
digest: the entry's best row and its number of rows.  Then runs meet in rounds:
every FAN runs become one, each round range-sorted by run and digest, equal
digests merged after their check values were compared.  After the last round
one sorted run holds one entry per text.  The way back goes from that run to
the first runs and from there to the rows, so no join key has more rows than
a run holds of one digest, however large a group of copies is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.text import SPACES, filled
from linkmill.plans.lineage import materialize

#: runs merged into one by a round
FAN = 16
_TEXT = ["digest", "check"]


def first_runs(partitions: int) -> int:
    """A power of FAN, at least ``partitions``: runs grow in number with the cluster."""
    runs = FAN
    while runs < partitions:
        runs *= FAN
    return runs


def _merged(entries: DataFrame, keys: list[str]) -> DataFrame:
    return entries.groupBy(*keys).agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))


def digests(docs: DataFrame, runs: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, number, run, digest and check value of the normalised text."""
    plain: Column = F.regexp_replace(filled(F.col(text)), SPACES, "")
    return (
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.length(filled(F.col(text))).alias("n"),
            plain.alias("plain"),
        )
        .select(
            "doc_id",
            "row",
            "n",
            F.unhex(F.sha2("plain", 256)).alias("digest"),
            F.xxhash64("plain", F.length("plain")).alias("check"),
        )
        .withColumn("run", F.pmod(F.xxhash64("doc_id", "n"), F.lit(runs)).cast("int"))
    )


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row's group of equal texts: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are once white space is deleted; null is empty.
    The row with the most code points stays, then the smallest id; a null id
    loses to any other.  Rows are judged one by one: of rows that repeat an id and
    are equal throughout one stays, too.
    """
    spark = docs.sparkSession
    runs = first_runs(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = materialize(digests(docs, runs, text, doc_id), "digests")
    best = F.struct((-F.col("n")).alias("n"), F.isnull("doc_id").alias("none"), "doc_id", "row")
    leaves = (
        rows.groupBy("run", *_TEXT)
        .agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("rows"))
    )
    leaves = materialize(leaves, "runs")
    level = leaves
    while runs > 1:
        runs //= FAN
        level = level.withColumn("run", F.floor(F.col("run") / FAN).cast("int"))
        level = _merged(level.repartitionByRange("run", "digest").sortWithinPartitions("run", "digest"), ["run", *_TEXT])
    top = level.select(*_TEXT, F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), F.col("rows").alias("group_size"))
    known = leaves.select("run", *_TEXT).join(top, _TEXT)
    return rows.join(known, ["run", *_TEXT]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
