"""Codebooks for parts of vectors, by Lloyd rounds over two trees.

Vectors are whole numbers, cut into equal parts; each part position has its own
codebook.  Every block of vectors has one tree per position over its parts, built
once: boxes, counts and sums of each node, and the parts in tree order.  A round
builds a tree over the entries of each codebook and goes down both at once.  A
pair of nodes goes when its least squared distance exceeds the most that some
other entry node of the same parts can have; between single entries one goes when
another is nearer at every point of the box.  A node of parts that is left with one
entry is assigned whole: its cached count and sum are added.  Leaves that are
left with several entries are measured in integers, ties to the lower index.
All bounds are exact integers, so the result is that of the plain method.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.vector_blocks import is_finite, moved, pack, totals, whole_numbers
from linkmill.plans.lineage import materialize
from linkmill.plans.sizes import small_side

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: parts in a leaf, and (leaf, entry) pairs measured at once
LEAF, PAIRS = 32, 32_768


@dataclass
class Tree:
    """Binary trees over equally many points, one for each position.

    ``points (positions, m, d)`` are in tree order, ``order (positions, m)`` says
    which point stands there, -1 for a copy that only fills up.  Level l has
    ``2**l`` nodes a position; ``low, high, counts, sums`` are lists by level.
    """

    points: np.ndarray
    order: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]
    counts: list[np.ndarray]
    sums: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.low) - 1


def arranged(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Points of all positions in tree order, their order, and the depth: halves at the widest side."""
    positions, n, d = points.shape
    depth = max(int(np.ceil(np.log2(max(n, 1) / leaf))), 0)
    size = -(-n // (1 << depth))
    fill = size * (1 << depth) - n
    points = np.concatenate([points, np.repeat(points[:, -1:], fill, axis=1)], axis=1)
    order = np.broadcast_to(np.append(np.arange(n), np.full(fill, -1)), points.shape[:2])
    for level in range(depth):
        cells = points.reshape(positions << level, -1, d)
        side = (cells.max(axis=1) - cells.min(axis=1)).argmax(axis=1)
        along = np.take_along_axis(cells, side[:, None, None], axis=2)[:, :, 0]
        rank = np.argsort(along, axis=1, kind="stable")
        points = np.take_along_axis(cells, rank[:, :, None], axis=1).reshape(points.shape)
        order = np.take_along_axis(order.reshape(rank.shape), rank, axis=1).reshape(points.shape[:2])
    return points, order, depth


def tree_of(points: np.ndarray, order: np.ndarray, depth: int) -> Tree:
    """The tree's nodes: boxes, and counts and sums of the true points."""
    positions, _, d = points.shape
    true = order >= 0
    low, high, counts, sums = [], [], [], []
    for level in range(depth + 1):
        cells = points.reshape(positions << level, -1, d)
        here = true.reshape(positions << level, -1)
        low.append(cells.min(axis=1))
        high.append(cells.max(axis=1))
        counts.append(here.sum(axis=1))
        sums.append((cells * here[:, :, None]).sum(axis=1))
    return Tree(points, order, low, high, counts, sums)


def _least(values: np.ndarray, starts: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The least value of each run, at every place of the run."""
    return np.repeat(np.minimum.reduceat(values, starts), runs)


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.diff(a, prepend=-1))
    return starts, np.diff(np.append(starts, len(a)))


def _pruned(a: np.ndarray, b: np.ndarray, low, high, elow, ehigh, names: np.ndarray | None) -> np.ndarray:
    """Which pairs of nodes stay; ``names`` are the entries' indexes once nodes are single entries."""
    if not len(a):
        return np.zeros(0, bool)
    lo, hi, el, eh = low[a], high[a], elow[b], ehigh[b]
    gap = np.maximum(np.maximum(el - hi, lo - eh), 0)
    far = np.maximum(hi - el, eh - lo)
    nearest, most = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
    starts, runs = _runs(a)
    bound = _least(most, starts, runs)
    keep = nearest <= bound
    if names is not None:
        # the entry with the least bound against each other one, over the whole box
        places = np.where(most == bound, np.arange(len(a)), len(a))
        best = _least(places, starts, runs)
        e, f = el, el[best]
        step = f - e
        worst = ((f - e) * (f + e) - 2 * np.where(step > 0, lo, hi) * step).sum(axis=1)
        beaten = (worst < 0) | ((worst == 0) & (names[b[best]] < names[b]))
        keep &= ~beaten | (best == np.arange(len(a)))
    return keep


def assign(tree: Tree, books: np.ndarray, codes: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Sums by (position, entry) as rows ``count, d sums``; with ``codes`` also each point's entry in tree order."""
    positions, entries, d = books.shape
    points, order, depth = arranged(books, 1)
    own = tree_of(points, order, depth)
    size = tree.points.shape[1]
    total = np.zeros((positions * entries, 1 + d), np.int64)
    chosen = np.zeros((positions, size), np.int64) if codes else None
    a = np.arange(positions)
    b = np.arange(positions)
    level = under = 0
    while True:
        single = under == own.depth
        names = own.order.reshape(-1) if single else None
        a, b = (x[own.counts[under][b] > 0] for x in (a, b))
        keep = _pruned(a, b, tree.low[level], tree.high[level], own.low[under], own.high[under], names)
        a, b = a[keep], b[keep]
        if single and len(a):
            starts, runs = _runs(a)
            alone = starts[runs == 1]
            node, entry = a[alone], names[b[alone]]
            slot = (node >> level) * entries + entry
            np.add.at(total, slot, np.column_stack([tree.counts[level][node], tree.sums[level][node]]))
            if codes:
                chosen.reshape(positions << level, -1)[node] = entry[:, None]
            open_ = np.repeat(runs > 1, runs)
            a, b = a[open_], b[open_]
        if single and level == tree.depth:
            break
        if not len(a):
            return total, chosen
        if not single:
            a, b = np.repeat(a, 2), np.column_stack([2 * b, 2 * b + 1]).ravel()
            under += 1
        if level < tree.depth:
            a, b = np.concatenate([2 * a, 2 * a + 1]), np.concatenate([b, b])
            level += 1
        rank = np.argsort(a, kind="stable")
        a, b = a[rank], b[rank]
    # leaves with several entries left: whole numbers, point by point
    leaves = tree.points.reshape(positions << level, -1, d)
    true = (tree.order >= 0).reshape(positions << level, -1)
    begins = _runs(a)[0]
    for at in _chunks(begins, len(a)):
        node, entry = a[at], names[b[at]]
        centre = books[node >> level, entry]
        far = np.zeros((len(node), leaves.shape[1]), np.int64)
        for k in range(d):
            step = leaves[node, :, k] - centre[:, k : k + 1]
            far += step * step
        starts, runs = _runs(node)
        ties = far == np.repeat(np.minimum.reduceat(far, starts), runs, axis=0)
        entry = np.minimum.reduceat(np.where(ties, entry[:, None], entries), starts)
        node = node[starts]
        slot = (node >> level)[:, None] * entries + entry
        here = true[node]
        np.add.at(total, slot[here], np.column_stack([np.ones(here.sum(), np.int64), leaves[node][here]]))
        if codes:
            chosen.reshape(positions << level, -1)[node] = entry
    return total, chosen


def _chunks(begins: np.ndarray, end: int) -> Iterator[slice]:
    """Slices of about PAIRS pairs that end between leaves."""
    begin = 0
    while begin < end:
        after = begins[np.searchsorted(begins, begin + PAIRS, "left") :]
        stop = int(after[0]) if len(after) else end
        yield slice(begin, stop)
        begin = stop


def _packed_tree(parts: int):
    def built(vectors: np.ndarray) -> dict[str, bytes]:
        points = vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2)
        points, order, depth = arranged(points, LEAF)
        tree = tree_of(points, order, depth)
        nodes = [np.concatenate(x).astype(t) for x, t in ((tree.low, "<i4"), (tree.high, "<i4"), (tree.counts, "<i8"), (tree.sums, "<i8"))]
        return {
            "points": points.astype("<i4").tobytes(),
            "places": order.astype("<i4").tobytes(),
            "nodes": b"".join(x.tobytes() for x in nodes),
        }

    return built


def _unpacked_tree(points: bytes, places: bytes, nodes: bytes, parts: int, d: int) -> Tree:
    order = np.frombuffer(places, "<i4").reshape(parts, -1)
    at, size = 0, len(nodes) // (4 * d + 4 * d + 8 + 8 * d)
    lists = []
    for kind, width in (("<i4", d), ("<i4", d), ("<i8", 1), ("<i8", d)):
        flat = np.frombuffer(nodes, kind, size * width, at).astype(np.int64)
        at += flat.size * np.dtype(kind).itemsize
        flat = flat.reshape(size, width)
        levels, begin, count = [], 0, parts
        while begin < size:
            levels.append(flat[begin : begin + count])
            begin, count = begin + count, 2 * count
        lists.append(levels)
    low, high, counts, sums = lists
    counts = [c.reshape(-1) for c in counts]
    return Tree(np.frombuffer(points, "<i4").astype(np.int64).reshape(parts, -1, d), order, low, high, counts, sums)


_BINARIES = ["points", "places", "nodes"]


def _head(vectors: DataFrame) -> list[list[int]]:
    """The first ENTRIES vectors by id; all have the length of the first."""
    first = F.struct(F.isnull("vec_id"), "vec_id", "cells")
    head = [r["cells"] for r in vectors.orderBy(first).limit(ENTRIES).collect()]
    if any(len(cells) != len(head[0]) for cells in head):
        return _head(vectors.where(F.size("cells") == len(head[0])))
    return head


def compress(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, code, error, label, label_error, codebooks_sha256`` for every kept vector.

    ``error`` is the squared distance of a vector to its entries, ``label_error``
    its sum over equal labels (nulls together).  Left out are null vectors, those
    that hold null or a non-finite component, and those whose length is no positive multiple of
    PARTS or differs from that of the kept vector that comes first: ids ascending, null
    ids last, then components.  In that order the first ENTRIES rows begin the codebooks (fewer rows,
    fewer entries); rows that repeat an id are rows of their own.  Components beyond
    2**24 / SCALE count as that.  Other columns are not looked at; no rows, no result.
    """
    spark = table.sparkSession
    cells = whole_numbers(F.col(f"`{vector}`"), SCALE).alias("cells")
    kept = table.where(is_finite(F.col(f"`{vector}`"))).select("vec_id", "label", cells)
    kept = kept.where((F.size("cells") > 0) & (F.size("cells") % PARTS == 0))
    head = _head(kept)
    schema = T.StructType(
        [kept.schema["vec_id"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), kept.schema["label"]]
    )
    if not head:
        none = spark.createDataFrame([], schema)
        return none.select("*", F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = len(head[0])
    d = width // PARTS
    books = np.array(head, np.int64).reshape(len(head), PARTS, d).transpose(1, 0, 2)
    entries = len(head)
    blocks = pack(kept.where(F.size("cells") == width), width, _packed_tree(PARTS), _BINARIES)

    def sums_under(now: np.ndarray):
        return lambda *binaries: assign(_unpacked_tree(*binaries, PARTS, d), now, False)[0]

    for _ in range(ROUNDS):
        found = totals(blocks, _BINARIES, PARTS * entries, 1 + d, sums_under(books))
        books = moved(books.reshape(-1, d), found[:, 0], found[:, 1:]).reshape(books.shape)

    names = [f.name for f in schema.fields]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels, *binaries = (batch.column(k) for k in range(batch.num_columns))
                tree = _unpacked_tree(*(x[i].as_py() for x in binaries), PARTS, d)
                chosen = assign(tree, books, True)[1]
                n = len(ids[i].values)
                codes, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
                for p in range(PARTS):
                    true = tree.order[p] >= 0
                    at = tree.order[p][true]
                    codes[at, p] = chosen[p][true]
                    step = tree.points[p][true] - books[p][chosen[p][true]]
                    error[at] += (step * step).sum(axis=1)
                text = codes.tobytes().hex()
                code = [text[k : k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays([ids[i].values, pa.array(code), pa.array(error), labels[i].values], names)

    told = materialize(blocks.select("vec_id", "label", *_BINARIES).mapInArrow(coded, schema), "codes")
    by_label = told.groupBy(F.col("label").alias("_of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    listed = ",".join(map(str, books.ravel().tolist()))
    return (
        told.join(small_side(materialize(by_label, "labels")), F.col("label").eqNullSafe(F.col("_of")))
        .select(*names, "label_error", F.lit(hashlib.sha256(listed.encode()).hexdigest()).alias("codebooks_sha256"))
    )
