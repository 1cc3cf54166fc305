"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated as often
as allowed.  A document's virtual finish time is the number of words its source
has sent once it is through, over the source's target.  All queues are range-sorted
by virtual finish time and truncated where the total budget is used up; the
document at the cut is taken in part.

Running sums never put a source into one task: rows are range-sorted over all tasks,
each task sums up its range, and the sums of the tasks before are added to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.llm.text import filled, space_words
from linkmill.plans.lineage import materialize, stored
from linkmill.plans.sizes import small_side

#: weights of the sources in order of their names, over and over
WEIGHTS = (5, 2, 1)
#: a source is sent this often at most
COPIES = 3


def shuffle_place(doc_id: Column) -> Column:
    """Place of a document in the shuffled order of its source."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """``source, source_size, target, total`` from ``source, source_size``, one row per source.

    The total is shared by weight; a target above ``copies`` times its source is
    cut to that and the rest shared again.  In order of size over weight the
    sources that are cut come first, so running sums tell them apart at once.
    """
    named = Window.orderBy(F.isnull("source"), "source")
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))))
    fullest = Window.orderBy(F.col("source_size") / F.col("weight"), F.isnull("source"), "source")
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = (
        sizes.withColumn("weight", weight)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("words_left", F.col("total") - copies * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # no division: words_left / weight_left above copies * size / weight
        .withColumn("full", copies * F.col("source_size") * F.col("weight_left") < F.col("words_left") * F.col("weight"))
        .withColumn("full", F.min("full").over(fullest))
    )
    rest = F.col("total") - copies * F.sum(F.when(F.col("full"), F.col("source_size")).otherwise(0)).over(everything)
    parts = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    share = (F.col("weight") * rest).cast("double") / parts
    return left.select(
        "source",
        "source_size",
        F.when(F.col("full"), (copies * F.col("source_size")).cast("double")).otherwise(share).alias("target"),
        "total",
    )


def running(rows: DataFrame, order: list, value: str, name: str) -> DataFrame:
    """``rows`` in the global ``order`` with ``name``, the sum of ``value`` up to and with each row.

    The sorted rows are written, so their places hold.  A window sees one range of the sort, or one
    row per range.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    task = F.shiftright("_place", 33)
    sums = placed.groupBy(task.alias("_task")).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_task", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_task").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("_task", task).join(F.broadcast(starts), "_task")
    return summed.withColumn(name, F.col("_start") + F.sum(value).over(inside)).drop("_task", "_place", "_start")


def mix_by_weight(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    copies: int = COPIES,
) -> DataFrame:
    """What the mix takes of every document: ``doc_id, source, size, source_size, target, taken``.

    ``size`` counts words between white space (null text: 0).  All words taken
    add up to all sizes; a source's differ from its target by less than its
    longest document and the extra needed to fill the budget.  The shuffled order is that of
    the ids' MD5 (a null id has that of an empty text), then of size, id and a hash of the text; rows that are
    equal in all of these are in either order alike.  Equal virtual times are ordered by source and place.
    Sources without words have target 0; rows that repeat an id are documents of their own.
    """
    sized = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.size(space_words(F.col(text))).cast("long").alias("size"),
        shuffle_place(F.col(doc_id)).alias("place"),
        F.xxhash64(filled(F.col(text))).alias("tie"),
    )
    sized = materialize(sized, "sizes")
    sources = stored(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, copies), "targets"
    )
    # where each source begins in the order of all sources
    ahead = Window.orderBy(F.isnull("source"), "source").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("source_size").over(ahead), F.lit(0)).alias("first")
    known = small_side(stored(sources.select(F.col("source").alias("its"), "source_size", "target", "total", first), "sources"))
    order = [F.isnull("source"), F.col("source"), "place", "size", "doc_id", "tie", "row"]
    queued = running(sized, order, "size", "upto").join(known, F.col("source").eqNullSafe(F.col("its")))
    queued = materialize(
        queued.select("row", "doc_id", "source", "size", "source_size", "target", "total", (F.col("upto") - F.col("first")).alias("sent")),
        "queues",
    )
    finishes = F.array(*[(F.col("sent") + copy * F.col("source_size")) / F.col("target") for copy in range(copies)])
    finishing = queued.where("size > 0").select(
        "row", "source", "sent", "size", "total", F.posexplode(finishes).alias("copy", "finish")
    )
    order = ["finish", F.isnull("source"), F.col("source"), "sent", "copy"]
    merged = running(finishing, order, "size", "used").where(F.col("used") - F.col("size") < F.col("total"))
    part = F.least("size", F.col("total") - F.col("used") + F.col("size"))
    taken = merged.groupBy("row").agg(F.sum(part).alias("taken"))
    return queued.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
