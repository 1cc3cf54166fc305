"""Similar texts by a chosen-path set similarity join.

A text is the set of its five-word shingles; equal sets are one class, which is
one row from here on.  A class has TOKENS minwise tokens: the least hash of its set under as
many hash functions, so two classes agree in each with probability J, their Jaccard similarity.

A tree starts with all classes in one node.  A node chooses some of the token
places, each with probability BOOST / (SIMILARITY * TOKENS) and by a hash of the node's
path, and sends each class to one child per chosen place, named by the
class's token there.  A pair at the threshold meets in BOOST children on average, so
it stays together from level to level with a probability that falls slowly; pairs
below SIMILARITY / BOOST die out.  Independent trees are repeated until a pair at the
threshold is missed with a probability of at most MISSED, worked out by :func:`trees`.

All trees begin at level START.  There the classes of every node are held against
its busiest one; nodes whose classes are then joined are done.  Of the others, small nodes are
compared exhaustively, large ones branch on, level by level, unless their classes are
so alike on average that branching would not part them.  Those, and what is still large and not joined
at level DEPTH, are compared in blocks.  Candidates that pass a comparison of their tokens are
counted on their whole sets, and only those that link count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.components import components
from linkmill.llm.hashing import U, mix, shingle_sets
from linkmill.llm.set_links import checked, encoded, links_in_blocks, named_once, sets_of, slices, text_key
from linkmill.plans.lineage import materialize, small_batches, stored
from linkmill.plans.sizes import small_side

PERCENT, SIMILARITY = 85, 0.85
#: minwise tokens, mean children of a pair at the threshold, first and last level, missed pairs
TOKENS, BOOST, START, DEPTH, MISSED = 64, 1.4, 2, 5, 1e-6
#: classes of a node that is compared exhaustively
SMALL = 24
#: a set below this size links with no other set
LEAST = 6
#: tokens in which two sets must agree to be counted: a pair that links has fewer with probability 3e-7
AGREE = 37
#: mean share of equal tokens from which on a node would not shrink
DENSE = SIMILARITY / BOOST

_draw = np.random.default_rng(1310)
_TIMES = _draw.integers(0, 2**31, TOKENS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _draw.integers(0, 2**32, TOKENS, dtype=np.uint32)
_PLACES = mix(np.arange(1, TOKENS + 1, dtype=U) * U(0x9E3779B97F4A7C15))
_CHOSEN = U(int(2**64 * BOOST / (SIMILARITY * TOKENS)))


def survival(mean: float, depth: int) -> float:
    """Probability that a branching with Poisson offspring of that mean lives to ``depth``."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-mean * alive)
    return alive


def missed(count: int, depth: int = DEPTH) -> float:
    """Probability that a pair at the threshold meets at level ``depth`` in none of ``count`` trees."""
    total = 0.0
    for k in range(TOKENS + 1):
        share = math.comb(TOKENS, k) * SIMILARITY**k * (1 - SIMILARITY) ** (TOKENS - k)
        total += share * (1 - survival(BOOST * k / (SIMILARITY * TOKENS), depth)) ** count
    return total


def trees(target: float = MISSED) -> int:
    """The fewest trees that miss at most ``target``."""
    count = 1
    while missed(count) > target:
        count += 1
    return count


def minwise(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Least hashes ``(sets, TOKENS)`` of sets that lie one after another; none may be empty."""
    if not len(sizes):
        return np.zeros((0, TOKENS), np.uint32)
    items = (sets >> U(32)).astype(np.uint32)
    begins = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), TOKENS), np.uint32)
    for k in range(TOKENS):
        out[:, k] = np.minimum.reduceat(items * _TIMES[k] + _PLUS[k], begins)
    return out


def children(nodes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node with the tokens of one class: the rows that go on, and the children they go to."""
    chosen = mix(nodes[:, None] + _PLACES[None, :]) < _CHOSEN
    row, place = np.nonzero(chosen)
    return row, mix(mix(nodes[row] ^ _PLACES[place]) + tokens[row, place].astype(U))


def first_nodes(tokens: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``tokens`` and their nodes at level START of all trees."""
    rows, nodes = [], []
    for tree in range(count):
        row = np.arange(len(tokens))
        node = np.full(len(tokens), mix(np.array([tree + 1], U))[0])
        for _ in range(START):
            at, node = children(node, tokens[row])
            row = row[at]
        rows.append(row)
        nodes.append(node)
    return np.concatenate(rows), np.concatenate(nodes)


def _matrix(column: pa.Array) -> np.ndarray:
    """Binary tokens of equal length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


_TOLD = "doc_id long, t1 long, t2 long, n long, k1 long, k2 long, tokens binary"


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, key and minwise tokens of every text; a set seen before in the task has no tokens."""
    seen: set[tuple[int, int]] = set()
    for whole in batches:
        for batch in slices(whole):
            sets, sizes = shingle_sets(encoded(batch.column("text")))
            begins = np.cumsum(sizes) - sizes
            filled = np.flatnonzero(sizes)
            keys = np.zeros((2, len(sizes)), U)
            if len(filled):
                keys[0, filled] = np.add.reduceat(sets, begins[filled])
                keys[1, filled] = np.add.reduceat(mix(sets + U(5)), begins[filled])
            fresh = []
            for i, pair in enumerate(zip(*keys.tolist(), strict=True)):
                if sizes[i] >= LEAST and pair not in seen:
                    seen.add(pair)
                    fresh.append(i)
            chosen = np.zeros(len(sizes), bool)
            chosen[fresh] = True
            found = iter(minwise(sets[np.repeat(chosen, sizes)], sizes[chosen]))
            tokens = [next(found).tobytes() if c else None for c in chosen.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "t1", "t2")]
                + [pa.array(x) for x in (sizes, keys[0].view(np.int64), keys[1].view(np.int64))]
                + [pa.array(tokens, pa.binary())],
                ["doc_id", "t1", "t2", "n", "k1", "k2", "tokens"],
            )


def _starting(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                row, node = first_nodes(_matrix(batch.column("tokens")), count)
                columns = [pa.array(node.view(np.int64)), batch.column("rep").take(row), batch.column("n").take(row)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "rep", "n"])

    return run


def _branched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            row, node = children(batch.column("node").to_numpy().view(U), _matrix(batch.column("tokens")))
            columns = [pa.array(node.view(np.int64)), batch.column("rep").take(row), batch.column("n").take(row)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "rep", "n"])


_ROW = "node long, rep long, n long"


def _same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal tokens of the rows' two classes."""
    for batch in batches:
        same = (_matrix(batch.column("x")) == _matrix(batch.column("y"))).sum(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(same)], ["node", "same"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with AGREE equal tokens or more."""
    for batch in batches:
        same = (_matrix(batch.column("x")) == _matrix(batch.column("y"))).sum(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array(same >= AGREE))


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of a small node that may link and are not joined yet; rows come sorted by node and class."""
    held: list[pa.RecordBatch] = []
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            rows = pa.Table.from_batches([*held, whole.slice(at, 4096)]).combine_chunks()
            node = rows.column("node").to_numpy()
            begin = int(np.argmax(node == node[-1]))
            held = rows.slice(begin).to_batches()
            yield _pairs(rows.slice(0, begin))
    if held:
        yield _pairs(pa.Table.from_batches(held))


def _pairs(rows: pa.Table) -> pa.RecordBatch:
    """Pairs ``a < b`` within the nodes, which are whole: each row against the one k places on."""
    node, rep, n, joined = (rows.column(c).to_numpy() for c in ("node", "rep", "n", "component"))
    tokens = _matrix(rows.column("tokens").combine_chunks()) if len(node) else None
    found = [(rep[:0], rep[:0])]
    for k in range(1, SMALL):
        i = np.flatnonzero(node[:-k] == node[k:])
        if not len(i):
            break
        j = i + k
        few, many = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        open_ = (100 * few >= PERCENT * many) & (joined[i] != joined[j])
        i, j = i[open_], j[open_]
        near = (tokens[i] == tokens[j]).sum(axis=1) >= AGREE
        found.append((rep[i[near]], rep[j[near]]))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _shared(rows: DataFrame) -> DataFrame:
    """Rows ``node, rep, n`` of nodes with two classes or more, with the node's ``size``."""
    rows = materialize(rows, "nodes")
    sizes = stored(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    return stored(rows.join(small_side(sizes), "node"), "shared")


def _with_pivots(shared: DataFrame) -> DataFrame:
    """Adds each node's ``pivot`` and ``pivot_n``: the class that shares most with others, most likely the original."""
    ties = shared.groupBy("rep").agg(F.sum("size").alias("ties"))
    ranked = shared.join(ties, "rep")
    first = F.max_by(F.struct("rep", "n"), F.struct("ties", -F.col("rep"))).alias("first")
    pivots = ranked.groupBy("node").agg(first).select("node", F.col("first.rep").alias("pivot"), F.col("first.n").alias("pivot_n"))
    return shared.join(pivots, "node")


def _torn(shared: DataFrame, reached: DataFrame) -> DataFrame:
    """Rows ``node, rep, n, size, component`` of the nodes whose classes lie in several components."""
    spread = shared.select("node", "rep", "n", "size").join(reached, "rep", "left")
    spread = stored(spread.withColumn("component", F.coalesce("component", "rep")), "spread")
    several = spread.groupBy("node").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return stored(spread.join(several.select("node"), "node", "left_semi"), "torn")


def _reached(links: DataFrame) -> DataFrame:
    return components(links).withColumnRenamed("node", "rep")


class _Classes:
    """Classes with their tokens, and the sets of those that were asked for."""

    def __init__(self, docs: DataFrame):
        keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *text_key())
        self.docs = docs
        # written, as rows must keep their numbers
        self.told = materialize(
            keyed.mapInArrow(_told, _TOLD).withColumn("row", F.monotonically_increasing_id()), "told"
        )
        self.copied = stored(named_once(self.told.where("n > 0")), "copied")
        some = self.told.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("rows"))
        copies = some.where("rows > 1").drop("rows")
        copies = small_side(stored(copies, "copies"))
        members = self.told.select("row", "n", "k1", "k2").join(copies, ["n", "k1", "k2"]).select("row", "rep")
        self.members = stored(members, "members")
        others = self.members.where("row != rep").select("row")
        first = self.told.where("tokens is not null").join(small_side(others), "row", "left_anti")
        self.reps = first.select(F.col("row").alias("rep"), "n", "t1", "t2", "tokens")

    def narrow(self, rows: DataFrame) -> None:
        """Go on with the classes in ``rows`` alone."""
        seen = stored(rows.select("rep").distinct(), "seen")
        self.reps = stored(self.reps.join(small_side(seen), "rep", "left_semi"), "reps")

    def with_tokens(self, rows: DataFrame) -> DataFrame:
        return self.reps.select("rep", "tokens").join(small_side(rows), "rep")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``(a, b)`` that link, after a look at their tokens, as a written table."""
        side = lambda c, x: self.reps.select(F.col("rep").alias(c), F.col("tokens").alias(x))
        near = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
        near = stored(near.mapInArrow(_agreeing, "a long, b long"), "near")
        return stored(checked(near, self.sets(near), PERCENT), "links")

    def sets(self, pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
        wanted = stored(self.reps.select("rep", "t1", "t2").join(small_side(wanted), "rep", "left_semi"), "wanted")
        return materialize(sets_of(self.docs, wanted, self.copied), "sets")


def similar_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Groups of similar texts: ``doc_id, n_shingles, component_id, kept``.

    Two rows link when 100 * intersection >= 85 * union of their sets of
    five-word shingles (words between white space, A-Z lower-cased; a text of
    fewer words is one shingle).  ``component_id`` is the smallest id reachable,
    ``kept`` whether it is the row's own.  Null or wordless texts have 0 shingles
    and link with nothing.  Every row is judged by its own text: rows that repeat an id are
    rows of their own (of equal ids that link, all are kept), a row with a null id
    links like any other and takes the smallest id there is, null if none.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    with small_batches(docs.sparkSession):
        classes = _Classes(docs)
        links = _links(classes)
    rows = (
        classes.told.select("row", "doc_id", "n")
        .join(classes.members, "row", "left")
        .withColumn("rep", F.coalesce("rep", "row"))
        .join(_reached(links), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    rows = materialize(rows, "reached")
    lowest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    lowest = stored(lowest.select("component", "component_id", F.lit(True).alias("found")), "lowest")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id"))
    named = rows.join(small_side(lowest), "component", "left").withColumn("component_id", component)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return named.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept)


def _links(classes: _Classes) -> DataFrame:
    """Links ``(a, b)`` between classes that join what all links join."""
    shared = _shared(classes.reps.mapInArrow(_starting(trees()), _ROW))
    classes.narrow(shared)
    pivoted = stored(_with_pivots(shared), "pivots")
    stars = pivoted.where(f"rep != pivot and 100 * least(n, pivot_n) >= {PERCENT} * greatest(n, pivot_n)")
    stars = stars.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    links = classes.linked(stars)
    reached = _reached(links)
    torn = _torn(pivoted, reached)
    pairs, blocks = [], []
    for level in range(START, DEPTH + 1):
        small = torn.where(F.col("size") <= SMALL).select("node", "rep", "n", "component")
        small = classes.with_tokens(small).repartition("node").sortWithinPartitions("node", "rep")
        pairs.append(stored(small.mapInArrow(_within, "a long, b long"), "pairs"))
        large = torn.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        dense = _dense(large, classes)
        blocks.append(large if level == DEPTH else large.join(dense, "node", "left_semi"))
        if level < DEPTH:
            rest = large.join(dense, "node", "left_anti").select("node", "rep", "n")
            torn = _torn(_shared(classes.with_tokens(stored(rest, "rest")).mapInArrow(_branched, _ROW)), reached)
    links = links.union(classes.linked(reduce(DataFrame.union, pairs).distinct()))
    if not blocks:
        return links
    large = _torn(reduce(DataFrame.union, blocks).drop("component"), _reached(links))
    if large.isEmpty():
        return links
    pivots = large.groupBy("node").agg(F.min("rep").alias("pivot"))
    large = stored(large.join(pivots, "node").select("node", "rep", "component", "pivot"), "large")
    sets = classes.sets(large.select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
    return links.union(stored(links_in_blocks(large, "pivot", sets, PERCENT), "links"))


def _dense(large: DataFrame, classes: _Classes) -> DataFrame:
    """The ``node``s whose classes have DENSE of their tokens in common with the first of them, on average."""
    heads = large.groupBy("node").agg(F.min("rep").alias("rep"))
    heads = stored(classes.with_tokens(stored(heads, "heads")).select("node", F.col("tokens").alias("y")), "heads")
    held_against = classes.with_tokens(large.select("node", "rep")).join(small_side(heads), "node")
    same = held_against.select("node", F.col("tokens").alias("x"), "y").mapInArrow(_same, "node long, same long")
    return stored(same.groupBy("node").agg(F.avg("same").alias("same")).where(F.col("same") >= DENSE * TOKENS).select("node"), "dense")
