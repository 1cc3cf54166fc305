"""Similarity join of shingle sets by PartEnum signatures.

Sets of m and n shingles with a Jaccard similarity of 3/4 or more differ in at
most (m + n) / 7 shingles.  Sets are banded by size (powers of two; a set that
can have a partner above its band is in the next one, too).  In a band whose
largest set has u shingles the domain of shingles is cut into more than 2u / 7
parts; two similar sets then agree on at least one whole part, and the
signature is that part's number and content.  The subsets enumerated are the
single parts: with one shingle in four or five parts allowed to differ, larger
subsets cost more signatures than they save candidates.

Agreement on an empty part says nothing.  Shingles that very many texts share
say little either, so a bounded list of them is set aside: leaving features out
never raises a distance, so the guarantee stands.  A set whose occupied parts
do not outnumber its largest possible distance (it is tiny, or made of frequent
shingles) is caught in the finest partition, of one shingle a part: it also
emits the m - ceil(3m/4) + 1 shingles that come first in one global order, rare
ones first; two similar sets must share one of those.  Both ways are exact.

Sets that share a signature are candidates.  Equal sets are one class.  Each
signature's most connected class is its pivot and is compared with the others.
Where a signature still spans several components, one class of each is compared
with one of the largest.  Where it spans several after that, all classes outside
the largest component are compared with those of other components, or block by
block if the signature is shared by many.  A pair is
checked by size, by a bitmap whose differing bits bound the distance from
below, and last by counting the intersection of the whole sets.  Blocks return a
forest of their links, not every link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.components import components
from linkmill.llm.hashing import U, mix, shingle_sets
from linkmill.llm.set_links import checked, encoded, links_in_blocks, named_once, sets_of, slices, text_key
from linkmill.plans.lineage import delete_path, fresh_path, materialize, scratch, small_batches, stored
from linkmill.plans.sizes import small_side

#: signatures in a bucket, on average; bounds the memory of a task
BUCKET = 250_000
#: signatures gathered in a task before they are sent
GATHER = 250_000
#: rows of one signature in a task from which on most go round its bucket
COMMON = 16
#: classes of one signature from which on they are compared in blocks
MANY = 48
PERCENT = 75
#: documents read to find frequent shingles, and how many of those are set aside at most;
#: both change only how many candidates there are, never which links are found
SAMPLE_DOCS, SAMPLE_SHARE, SAMPLE_TIMES, FREQUENT = 200_000, 1 / 16, 3, 200_000
_LOW40 = U((1 << 40) - 1)


def frequent_shingles(docs: DataFrame, rows: int) -> np.ndarray:
    """Sorted shingles found SAMPLE_TIMES or more in a sample: at most FREQUENT, commonest first."""
    share = min(SAMPLE_SHARE, SAMPLE_DOCS / max(rows, 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found, times = np.unique(shingle_sets(encoded(part.column("text")))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(times)], ["shingle", "times"]
                )

    counted = (
        docs.select("text")
        .sample(share, seed=8)
        .mapInArrow(count, "shingle long, times long")
        .groupBy("shingle")
        .agg(F.sum("times").alias("times"))
        .where(F.col("times") >= SAMPLE_TIMES)
        .orderBy(F.desc("times"), "shingle")
        .limit(FREQUENT)
    )
    table = counted.toPandas()
    return np.array(sorted(zip(table.shingle.to_numpy(np.int64).view(U).tolist(), table.times.tolist(), strict=True)), U).reshape(-1, 2)


def bands(size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sets, largest size of the band) for each set's own band and for those in the next."""
    top = 1 << np.ceil(np.log2(np.maximum(size, 1) + 1)).astype(np.int64)
    return [
        (np.flatnonzero(size > 0), top - 1),
        (np.flatnonzero((size > 0) & (4 * size >= 3 * top)), 2 * top - 1),
    ]


def parts_of(largest: np.ndarray) -> np.ndarray:
    """Number of parts of a band: its distance bound and about a sixth more."""
    return (2 * largest // 7 + 1) * 23 // 20 + 1


def signatures(
    sets: np.ndarray, sizes: np.ndarray, frequent: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the sets and the set each belongs to."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    often = np.zeros(len(sets), bool)
    if len(frequent):
        flags = np.zeros(1 << 22, bool)
        flags[frequent[:, 0] & U((1 << 22) - 1)] = True
        maybe = np.flatnonzero(flags[sets & U((1 << 22) - 1)])
        at = np.minimum(np.searchsorted(frequent[:, 0], sets[maybe]), len(frequent) - 1)
        often[maybe] = frequent[at, 0] == sets[maybe]
    rare, rare_owner = sets[~often], owner[~often]
    marks, owners = [], []
    weak = np.zeros(len(sizes), bool)
    for members, largest in bands(sizes):
        chosen = np.zeros(len(sizes), bool)
        chosen[members] = True
        parts = np.where(chosen, parts_of(largest), 0)
        first = np.cumsum(parts) - parts
        take = chosen[rare_owner]
        items, whose = rare[take], rare_owner[take]
        part = ((items >> U(20)) % parts[whose].astype(U)).astype(np.int64)
        cell = first[whose] + part
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else cell
        content = np.add.reduceat(mix(items[order] + U(77)), new) if len(new) else items
        whose, part = whose[order][new], part[order][new]
        marks.append(mix(content + mix(part.astype(U) * U(1_000_003) + largest[whose].astype(U))))
        owners.append(whose)
        occupied = np.bincount(whose, minlength=len(sizes))
        bound = (sizes + np.minimum(largest, 4 * sizes // 3)) // 7
        weak |= chosen & (occupied <= bound)
    if weak.any():
        ends = np.cumsum(sizes)
        for i in np.flatnonzero(weak).tolist():
            row, common = sets[ends[i] - sizes[i] : ends[i]], often[ends[i] - sizes[i] : ends[i]]
            times = np.zeros(len(row), np.int64)
            times[common] = frequent[np.searchsorted(frequent[:, 0], row[common]), 1]
            row = row[np.lexsort((row, times))][: len(row) - (3 * len(row) + 3) // 4 + 1]
            marks.append(mix(row + U(991)))
            owners.append(np.full(len(row), i))
    return np.concatenate(marks), np.concatenate(owners)


def _bitmaps(sets: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """A bitmap per set with one bit per shingle (bits may meet), four to eight bits a shingle."""
    bits = 4 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
    first = np.cumsum(bits) - bits
    owner = np.repeat(np.arange(len(sizes)), sizes)
    flags = np.zeros(int(bits.sum()), bool)
    flags[first[owner] + ((sets >> U(7)) & (bits[owner] - 1).astype(U)).astype(np.int64)] = True
    packed = np.packbits(flags).tobytes()
    return [packed[a // 8 : (a + n) // 8] for a, n in zip(first.tolist(), bits.tolist(), strict=True)]


def _folded(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return x, y


_DOC = [("doc_id", pa.int64()), ("id", pa.int64())] + [(c, pa.int64()) for c in ("n", "k1", "k2", "t1", "t2")]
_SCHEMA = pa.schema([("bucket", pa.int32()), *_DOC] + [(c, pa.binary()) for c in ("bitmap", "marks", "places")])
_ROW = "bucket int, doc_id long, id long, n long, k1 long, k2 long, t1 long, t2 long, bitmap binary, marks binary, places binary"


def _signed(buckets: int, frequent):
    """Task function: rows of documents (negative bucket) and of signatures packed by bucket.

    The first text of each set in a task has an ``id``: the task, one of its gatherings of
    signatures, and the place there.  A packed signature is the mark without its bucket and that place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[tuple] = set()
        base, place, count = TaskContext.get().partitionId() << 32, 0, 0

        def packed() -> pa.RecordBatch:
            marks = np.concatenate([m for m, _ in held])
            places = np.concatenate([i for _, i in held])
            held.clear()
            bucket = ((marks >> U(40)) % U(buckets)).astype(np.int64)
            name = ((bucket.astype(U) << U(40)) | (marks & _LOW40)).view(np.int64)
            order = np.argsort(name, kind="stable")
            bucket, places, name = bucket[order], places[order], name[order]
            begin = np.flatnonzero(np.diff(name, prepend=-1))
            times = np.diff(np.append(begin, len(name)))
            rank = np.arange(len(name)) - np.repeat(begin, times)
            # of a signature that is common here already, two rows stand for it in its bucket
            known = (np.repeat(times, times) > COMMON) & (rank > 1)
            rows = []
            for at in range(0, int(known.sum()), BUCKET // 4):
                take = np.flatnonzero(known)[at : at + BUCKET // 4]
                packs = {"marks": name[take].tobytes(), "places": places[take].astype("<u2").tobytes()}
                rows.append({"bucket": -1 - int(name[take[0]] + places[take[-1]]) % buckets, "id": base, **packs})
            bucket, places, name = bucket[~known], places[~known].astype("<u2"), name[~known]
            low = name.view(np.uint8).reshape(-1, 8)[:, :5]
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(bucket)).tolist(), strict=True):
                rows.append({"bucket": int(bucket[a]), "id": base, "marks": low[a:b].tobytes(), "places": places[a:b].tobytes()})
            return pa.RecordBatch.from_pylist(rows, _SCHEMA)

        for whole in batches:
            for batch in slices(whole):
                sets, sizes = shingle_sets(encoded(batch.column("text")))
                ends = np.cumsum(sizes)
                keys = np.zeros((2, len(sizes)), U)
                filled = np.flatnonzero(sizes)
                if len(filled):
                    keys[0, filled] = np.add.reduceat(sets, (ends - sizes)[filled])
                    keys[1, filled] = np.add.reduceat(mix(sets + U(5)), (ends - sizes)[filled])
                fresh = []
                for i, key in enumerate(zip(sizes.tolist(), *keys.tolist(), strict=True)):
                    if sizes[i] and key not in seen:
                        seen.add(key)
                        fresh.append(i)
                if held and place + len(fresh) > 1 << 16:
                    yield packed()
                    base, place, count = base + (1 << 16), 0, 0
                chosen = np.zeros(len(sizes), bool)
                chosen[fresh] = True
                own = sets[np.repeat(chosen, sizes)]
                ids = np.full(len(sizes), -1)
                ids[fresh] = base + place + np.arange(len(fresh))
                bitmaps = iter(_bitmaps(own, sizes[chosen]))
                columns = {
                    "bucket": pa.array(-1 - np.arange(len(sizes)) % buckets, pa.int32()),
                    "doc_id": batch.column("doc_id"),
                    "id": pa.array(ids, pa.int64(), mask=~chosen),
                    "n": pa.array(sizes),
                    "k1": pa.array(keys[0].view(np.int64)),
                    "k2": pa.array(keys[1].view(np.int64)),
                    "t1": batch.column("t1"),
                    "t2": batch.column("t2"),
                    "bitmap": pa.array([next(bitmaps) if c else None for c in chosen.tolist()], pa.binary()),
                }
                blank = pa.nulls(len(sizes), pa.binary())
                yield pa.RecordBatch.from_arrays([columns.get(f.name, blank) for f in _SCHEMA], schema=_SCHEMA)
                if fresh:
                    marks, whose = signatures(own, sizes[chosen], frequent.value)
                    held.append((marks, place + whose))
                    place += len(fresh)
                    count += len(marks)
                if count >= GATHER:
                    yield packed()
                    base, place, count = base + (1 << 16), 0, 0
        if held:
            yield packed()

    return run


_FOUND = "kind string, mark long, doc_id long, id long, n long, k1 long, k2 long, t1 long, t2 long, bitmap binary"
_FOUND_SCHEMA = pa.schema([("kind", pa.string()), ("mark", pa.int64()), *_DOC, ("bitmap", pa.binary())])


def _found(rows: int, kind: str, **columns: pa.ChunkedArray | np.ndarray) -> pa.Table:
    """``rows`` rows of _FOUND; columns not given are null."""
    columns["kind"] = pa.repeat(kind, rows)
    return pa.table(
        [columns[x.name] if x.name in columns else pa.nulls(rows, x.type) for x in _FOUND_SCHEMA],
        schema=_FOUND_SCHEMA,
    )


def _unpacked(rows: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Marks (as packed bytes) and ids of packed rows."""
    marks = [np.frombuffer(x.as_buffer(), np.uint8) for x in rows.column("marks")]
    bases = rows.column("id").to_pylist()
    places = [np.frombuffer(x.as_buffer(), "<u2") for x in rows.column("places")]
    return marks, [base + place.astype(np.int64) for base, place in zip(bases, places, strict=True)]


def _shared(rows: pa.Table) -> pa.Table:
    """Of a bucket: the (signature, set) rows of signatures that two rows have.

    Arrow on both ends: ids stay 64-bit integers beside nulls.
    """
    bucket = rows.column("bucket")[0].as_py()
    if bucket < 0:
        sure = pc.is_valid(rows.column("marks"))
        docs = rows.filter(pc.invert(sure))
        plain = {name: docs.column(name) for name in (*(c for c, _ in _DOC), "bitmap")}
        marks, ids = _unpacked(rows.filter(sure))
        found = [_found(len(i), "mark", mark=m.view(np.int64), id=i) for m, i in zip(marks, ids, strict=True)]
        return pa.concat_tables([_found(len(docs), "doc", **plain), *found])
    marks, ids = _unpacked(rows)
    whole = np.zeros((sum(map(len, ids)), 8), np.uint8)
    whole[:, :5] = np.concatenate(marks).reshape(-1, 5)
    mark, ids = whole.view(np.int64).ravel(), np.concatenate(ids)
    order = np.argsort(mark)
    mark, ids = mark[order], ids[order]
    same = mark[1:] == mark[:-1]
    keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    return _found(int(keep.sum()), "mark", mark=mark[keep] + (bucket << 40), id=ids[keep])


def _near_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bitmaps allow 100 * intersection >= 75 * union."""
    for batch in batches:
        a, b, n, m, x, y = (batch.column(i).to_pylist() for i in range(6))
        keep = []
        for i in range(len(a)):
            p, q = _folded(x[i], y[i])
            keep.append(7 * int(np.bitwise_count(p ^ q).sum()) <= n[i] + m[i])
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _links(pairs: DataFrame, known: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of class representatives that are similar."""
    side = lambda c, n, m: known.select(
        F.col("rep").alias(c), F.col("n").alias(n), F.col("bitmap").alias(m)
    )
    near = (
        pairs.join(side("a", "n", "x"), "a")
        .join(side("b", "m", "y"), "b")
        .where(F.least("n", "m") * 100 >= F.greatest("n", "m") * PERCENT)
        .select("a", "b", "n", "m", "x", "y")
        .mapInArrow(_near_enough, "a long, b long")
    )
    return stored(checked(stored(near, "near"), sets, PERCENT), "links")


def _pairs(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _torn(shared: DataFrame, links: DataFrame) -> DataFrame:
    """``mark, rep, component`` of the signatures whose classes lie in several components."""
    reached = components(links).withColumnRenamed("node", "rep")
    spread = shared.join(small_side(reached), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    several = spread.groupBy("mark").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = stored(several.where("low < high").select("mark"), "several")
    return stored(spread.join(small_side(several), "mark", "left_semi"), "torn")


def _with_main(torn: DataFrame) -> DataFrame:
    """Adds ``main``, the largest component of each signature, and ``classes``, its number of classes."""
    counts = torn.groupBy("mark", "component").agg(F.count(F.lit(1)).alias("reps"))
    main = F.max_by("component", F.struct("reps", "component")).alias("main")
    return torn.join(counts.groupBy("mark").agg(main, F.sum("reps").alias("classes")), "mark")


def similar_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Groups of similar texts: ``doc_id, n_shingles, component_id``, as a written table.

    Two rows link when 100 * intersection >= 75 * union of their sets of
    five-word shingles (words between white space, A-Z lower-cased; a text of
    fewer words is one shingle); ``component_id`` is the smallest id reachable.
    Null or wordless texts have 0 shingles and link with nothing.  Ids are whole numbers.  Every
    row is judged by its own text: rows that repeat an id are rows of their own, a row with a null
    id links like any other and takes the smallest id there is, null if none.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with scratch(spark), small_batches(spark):
        known, members, shared = _signatures(docs)
        classes = known.where("id is not null").join(small_side(members.where("id != rep")), "id", "left_anti")
        classes = classes.select(F.col("id").alias("rep"), "n", "t1", "t2", "bitmap")
        copied = stored(named_once(known.where("n > 0")), "copied")
        links = _all_links(docs, classes, shared, copied)
        reached = components(links).withColumnRenamed("node", "rep")
        rows = known.select("doc_id", "n", "k1", "k2", "id").join(
            small_side(members.select("n", "k1", "k2", "rep").distinct()), ["n", "k1", "k2"], "left"
        )
        rows = rows.withColumn("rep", F.coalesce("rep", "id")).join(small_side(reached), "rep", "left")
        rows = materialize(rows.select("doc_id", "n", F.coalesce("component", "rep").alias("component")), "rows")
        lowest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
        lowest = lowest.where("size > 1 and component is not null")
        lowest = stored(lowest.select("component", "component_id", F.lit(True).alias("several")), "lowest")
        component = F.when(F.col("several"), F.col("component_id")).otherwise(F.col("doc_id"))
        told = rows.join(small_side(lowest), "component", "left")
        told = told.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        return materialize(told, "groups", lasting=True)


def _signatures(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of documents, the sets that several have, and ``mark, rep, reps`` of signatures that two classes or more have."""
    spark = docs.sparkSession
    rows, chars = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, rows))
    buckets = min(max(chars // (9 * BUCKET), 1), 1 << 22)
    path = fresh_path(spark, "signatures")
    (
        docs.select("doc_id", "text", *text_key())
        .mapInArrow(_signed(buckets, frequent), _ROW)
        .groupBy("bucket")
        .applyInArrow(_shared, _FOUND)
        .write.partitionBy("kind")
        .parquet(path)
    )
    found = spark.read.schema(_FOUND).parquet(path)
    with scratch(spark):
        known = stored(found.where("kind = 'doc'").drop("kind", "mark"), "known", lasting=True)
        members = _members(known)
        moved = members.where("id != rep").select("id", "rep")
        marks = found.where("kind = 'mark'").select("mark", "id").join(small_side(moved), "id", "left")
        marks = materialize(marks.select("mark", F.coalesce("rep", "id").alias("rep")).distinct(), "marks")
        delete_path(spark, path)
        sizes = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("reps")).where("reps > 1")
        shared = materialize(marks.join(sizes, "mark"), "shared", lasting=True)
    return known, members, shared


def _members(known: DataFrame) -> DataFrame:
    """``n, k1, k2, id, rep`` of the sets that several rows have: their first row stands for all."""
    key = ["n", "k1", "k2"]
    some = known.where("n > 0").groupBy(*key).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    some = stored(some.where("rows > 1").drop("rows"), "copies")
    return stored(known.where("id is not null").select(*key, "id").join(small_side(some), key), "members", lasting=True)


def _all_links(docs: DataFrame, classes: DataFrame, shared: DataFrame, copied: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between classes that join what all links join."""
    # the class that shares most with others comes first: of edited copies, most likely the original
    ties = stored(shared.groupBy("rep").agg(F.sum("reps").alias("ties")), "ties")
    first = F.struct(F.col("ties"), (-F.col("rep")).alias("early"))
    ranked = shared.join(small_side(ties), "rep")
    pivots = ranked.groupBy("mark").agg(F.max_by("rep", first).alias("pivot"))
    stars = shared.join(pivots, "mark").where("rep != pivot").select(*_pairs("pivot", "rep")).distinct()
    classes = stored(classes.join(small_side(ties.select("rep")), "rep", "left_semi"), "classes")
    sets = materialize(sets_of(docs, classes.select("rep", "t1", "t2"), copied), "sets")
    links = _links(stars, classes, sets)

    # one class of each component against one of the signature's largest: this joins most of them
    torn = _with_main(_torn(shared, links)).join(small_side(ties), "rep")
    best = F.max_by("rep", F.struct("ties", "rep"))
    heads = stored(torn.groupBy("mark", "main", "component").agg(best.alias("rep")), "heads")
    mains = heads.where("component = main").select("mark", F.col("rep").alias("head"))
    bridges = heads.where("component != main").join(mains, "mark").select(*_pairs("head", "rep")).distinct()
    links = links.union(_links(bridges, classes, sets))

    torn = stored(_with_main(_torn(shared, links)), "torn")
    few = torn.where(F.col("classes") <= MANY)
    ones = few.where("component != main").select("mark", F.col("rep").alias("one"), F.col("component").alias("its"))
    rest = few.join(ones, "mark").where("component != its and (component = main or one < rep)")
    links = links.union(_links(rest.select(*_pairs("one", "rep")).distinct(), classes, sets))
    many = torn.where(F.col("classes") > MANY)
    if many.isEmpty():
        return links
    pivots = many.groupBy("mark").agg(F.min("rep").alias("pivot"))
    many = stored(many.join(pivots, "mark").select("rep", "component", "pivot").distinct(), "many")
    return links.union(stored(links_in_blocks(many, "pivot", sets, PERCENT), "links"))
