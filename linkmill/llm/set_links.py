"""Exact checks of candidate pairs of sets, and links among many sets as forests.

A set is a row ``rep, items`` with its distinct shingles as array<long>; two sets
link when ``100 * intersection >= percent * union``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.components import components
from linkmill.llm.hashing import shingle_sets
from linkmill.plans.lineage import stored
from linkmill.plans.sizes import small_side

#: sets in a block, and columns of an incidence matrix that are held at once
BLOCK, COLUMNS = 192, 16_384


def text_key() -> list:
    """Columns that name a text: two hashes and the size, over 100 bits that no two texts of a corpus share."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return [F.xxhash64("text").alias("t1"), F.shiftleft(size, 32).bitwiseXOR(F.hash("text").cast("long")).alias("t2")]


def slices(batch: pa.RecordBatch, size: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``size`` bytes of its column ``text``."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > size:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def encoded(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def named_once(told: DataFrame) -> DataFrame:
    """``t1, t2`` of the texts that more than one row of ``told`` has."""
    return told.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("t1", "t2")


def sets_of(docs: DataFrame, wanted: DataFrame, copied: DataFrame) -> DataFrame:
    """``rep, n, items`` for ``wanted (rep, t1, t2)`` out of the texts of ``docs``.

    Texts become sets where they are scanned; only those that several rows have, ``copied (t1, t2)``, are
    brought together first, one for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found, sizes = shingle_sets(encoded(batch.column("text")))
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                items = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sizes), items], ["rep", "n", "items"])

    marked = wanted.join(small_side(copied.withColumn("copied", F.lit(True))), ["t1", "t2"], "left")
    marked = stored(marked.select("rep", "t1", "t2", F.coalesce("copied", F.lit(False)).alias("copied")), "wanted")
    texts = docs.select("text", *text_key())
    alone = texts.join(small_side(marked.where("not copied")), ["t1", "t2"]).select("rep", "text")
    shared = texts.join(small_side(marked.where("copied")), ["t1", "t2"]).groupBy("rep").agg(F.min("text").alias("text"))
    return alone.union(shared).mapInArrow(run, "rep long, n long, items array<long>")


def checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link, counted on their whole sets."""
    side = lambda c, n, x: sets.select(F.col("rep").alias(c), F.col("n").alias(n), F.col("items").alias(x))
    both = F.size(F.array_intersect("x", "y"))
    needed = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    sets = sets.join(small_side(stored(needed, "needed")), "rep", "left_semi")
    met = pairs.select("a", "b").join(side("a", "n", "x"), "a").join(side("b", "m", "y"), "b")
    return met.where(both * 100 >= (F.col("n") + F.col("m") - both) * percent).select("a", "b")


def _incidence(owner: np.ndarray, items: np.ndarray, count: int, names: np.ndarray) -> np.ndarray:
    spot = np.minimum(np.searchsorted(names, items), len(names) - 1)
    here = names[spot] == items
    matrix = np.zeros((count, len(names)), np.float32)
    matrix[owner[here], spot[here]] = 1
    return matrix


def forest(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the links between ``a`` and ``b`` join: one less than there are sets, at most."""
    names = np.unique(np.concatenate([a, b]))
    label = np.arange(len(names))
    x, y = np.nonzero(linked)
    x, y = np.searchsorted(names, a[x]), np.searchsorted(names, b[y])
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = new[new]
        if (new == label).all():
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(names)))
    return names[label[child]], names[child]


def block_forest(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Task function: a forest of the links between two blocks of sets (or within one)."""

    def side(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        items = rows.column("items").combine_chunks()
        sizes = pc.list_value_length(items).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(items).to_numpy(zero_copy_only=False)
        return rows.column("rep").to_numpy(), np.repeat(np.arange(len(sizes)), sizes), flat, sizes

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rep")
        low, high = rows.column("low")[0], rows.column("high")[0]
        first = side(rows.filter(pc.equal(rows.column("block"), low)))
        second = first if low.equals(high) else side(rows.filter(pc.equal(rows.column("block"), high)))
        (a, of_a, in_a, size_a), (b, of_b, in_b, size_b) = first, second
        common = np.intersect1d(in_a, in_b)
        both = np.zeros((len(a), len(b)))
        for at in range(0, len(common), COLUMNS):
            names = common[at : at + COLUMNS]
            both += _incidence(of_a, in_a, len(a), names) @ _incidence(of_b, in_b, len(b), names).T
        linked = 100 * both >= percent * (size_a[:, None] + size_b[None, :] - both)
        x, y = forest(linked, a, b)
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    return run


def links_in_blocks(nodes: DataFrame, pivot: str, sets: DataFrame, percent: int) -> DataFrame:
    """Forests of the links among sets that share a node but not a component, for nodes of any size.

    ``nodes`` has ``rep``, its ``component`` so far, and a column that names one member of the
    row's node.  Sets that nodes join are of one kind.  The largest component of a kind and the other sets are
    dealt into blocks of about BLOCK by a hash; each two blocks meet in one task, unless both
    are of that component.  A task holds two blocks and returns at most one row per set.
    """
    edges = nodes.where(F.col("rep") != F.col(pivot)).select(F.col("rep").alias("a"), F.col(pivot).alias("b"))
    kinds = components(edges.distinct()).select(F.col("node").alias("rep"), F.col("component").alias("kind"))
    members = stored(nodes.select("rep", "component").distinct().join(kinds, "rep"), "kinds")
    sized = members.groupBy("kind", "component").agg(F.count(F.lit(1)).alias("size"))
    most = F.max_by("component", F.struct("size", "component")).alias("main")
    shape = sized.groupBy("kind").agg(most, F.max("size").alias("mains"), F.sum("size").alias("all"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    shape = shape.select("kind", "main", blocks(F.col("mains")).alias("inner"), blocks(F.col("all") - F.col("mains")).alias("outer"))
    place, main = F.xxhash64("rep"), F.col("component") == F.col("main")
    own = F.when(main, F.col("outer") + F.pmod(place, F.col("inner"))).otherwise(F.pmod(place, F.col("outer")))
    last = F.when(main, F.col("outer") - 1).otherwise(F.col("outer") + F.col("inner") - 1)
    dealt = (
        members.join(shape, "kind")
        .where("outer > 0")
        .withColumn("block", own.cast("int"))
        .join(sets.select("rep", "items"), "rep")
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select("kind", "rep", "block", "items", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    return dealt.groupBy("kind", "low", "high").applyInArrow(block_forest(percent), "a long, b long")
