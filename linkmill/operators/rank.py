"""The steps of one ranking round, and the link table they run on.

Links are kept flat, one row per distinct ``(src, dst)`` with ``weight`` =
copies of the link / links of the source.  A round is then one join with the
ranks and one aggregate by target:

* inner join: a source without a rank drops out, a node without links gives
  nothing on;
* "keep": every source carries one extra link to itself of weight 0, so it
  always receives a sum, if only 0.  The round itself stays the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmill.fixed_values import RANK_BASE, RANK_FACTOR, RANK_START
from linkmill.plans import skew
from linkmill.plans.lineage import fresh_path, materialize, planned_session, swept

MIN_SLICE_ROWS = 1_000_000
#: rows of a hash class; rounds send a number per class and target, so fewer, larger classes send less
ROWS_PER_PARTITION = 4_000_000
#: hash groups of sources that are counted to find those that may be heavy
_SOURCE_GROUPS = 1 << 16


@dataclass
class Links:
    """Weighted links, partitioned and sorted by ``keys``, in a session planned for their partitions.

    ``declared`` is the number of hash classes asked for; ``partitions``, which divides
    it, is the number of tasks they are folded into.
    """

    rows: DataFrame
    keys: list[str]
    partitions: int
    declared: int
    unnamed: int = 0
    heavy: DataFrame | None = None
    stored: str | None = None

    def n_sources(self) -> int:
        """Distinct sources; links without one count as those of one more."""
        return self.rows.select("src").distinct().count() + self.unnamed

    def release(self) -> None:
        """Free the executor copies, and the name of a stored table."""
        self.rows.unpersist()
        if self.stored:
            self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.stored}")


def link_table(
    edges: DataFrame,
    sources: str = "drop",
    num_partitions: int | None = None,
    cache_links: bool = True,
    min_slice_rows: int = MIN_SLICE_ROWS,
    self_links: bool = True,
    held: bool = True,
) -> Links:
    """Turn a bag of edges into the weighted link table of a ranking run.

    The edges are written once, so the input is scanned a single time, and placed by
    source in one shuffle; there repeated links are counted and sources get their number of links
    without another.  Sources that may have too many targets for one partition, found by counting
    edges in hash groups of sources, go another way: their links are counted with a map-side
    combine first, then sliced.  With ``cache_links``
    the executors keep the placed links, else they are a bucketed and sorted table on shared storage,
    which every round scans as it lies.  Without ``self_links``, "keep" adds its extra links only to
    sliced sources; the caller then adds up the sources itself.  Without ``held``, links that are not sliced are
    neither kept nor stored: they are placed when the caller reads them, once.
    """
    if sources not in ("drop", "keep"):
        raise ValueError(f"sources must be 'drop' or 'keep', not {sources!r}")
    spark = edges.sparkSession
    with swept(spark):
        written = materialize(edges.select("src", "dst"), "links", compression="zstd")
    total = written.count()
    fitting = _fitting_partitions(spark, total)
    declared = num_partitions or fitting
    partitions = folded(declared, fitting)
    own = planned_session(spark, partitions, **_BUCKETS)
    written = _read_in(own, written)
    unnamed = written.where("src IS NULL").limit(1).count()
    # a link without a source counts as one of a source that never has a rank
    light, copies = written.where("src IS NOT NULL"), F.lit(1).cast("long").alias("copies")

    size = skew.slice_size(total, partitions, min_slice_rows)
    group = F.pmod(F.hash("src"), F.lit(_SOURCE_GROUPS))
    full = light.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > size).collect()
    heavy, keys, placed = None, ["src"], light.select("src", "dst")
    if full:
        crowded = group.isin([r["g"] for r in full])
        counted = materialize(
            light.where(crowded).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies")), "counted"
        )
        degrees = counted.groupBy("src").agg(F.sum("copies").alias("n_links"), F.count(F.lit(1)).alias("n_targets"))
        large = materialize(degrees.where(F.col("n_targets") > size), "heavy")
        placed = light.where(~crowded).select("src", "dst", copies).unionByName(counted)
        if not large.isEmpty():
            heavy = skew.heavy_keys(large, "src", "n_targets", size)
            keys = ["src", skew.SLICE]
            placed = skew.add_slice(placed, "src", heavy, F.xxhash64("dst"))

    # one sort serves all that is counted: a class has one copy of its rows in memory, and no hash table
    placed = placed.repartition(partitions, *keys)
    of_link = Window.partitionBy(*keys, "dst").orderBy("dst")
    every_copy = of_link.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = F.sum("copies") if full else F.count(F.lit(1))
    placed = placed.withColumns({"copies": counts.over(every_copy), "copy": F.row_number().over(of_link)}).where("copy = 1")
    of_source = Window.partitionBy(*keys)
    n_links = F.sum("copies").over(of_source)
    if heavy is not None:
        placed = placed.join(F.broadcast(large.select("src", F.col("n_links").alias("of_all"))), "src", "left")
        n_links = F.coalesce("of_all", n_links)
    rows = placed.select(*keys, "dst", (F.col("copies") / n_links).alias("weight"))
    if sources == "keep" and (self_links or heavy is not None):
        place = F.row_number().over(of_source.orderBy("dst"))
        given = F.struct("dst", "weight")
        itself = F.struct(F.col("src").alias("dst"), F.lit(0.0).alias("weight"))
        links = F.when(F.col("place") == 1, F.array(given, itself)).otherwise(F.array(given))
        rows = rows.withColumn("place", place).select(*keys, F.inline(links))
    rows = rows.sortWithinPartitions(*keys)
    stored = None
    if not held and heavy is None:
        return Links(rows, keys, partitions, declared, unnamed)
    if cache_links:
        # filled now: only a filled cache tells the planner its partitioning
        rows = rows.persist()
        rows.count()
    else:
        rows, stored = bucketed(rows, partitions, keys)
    return Links(rows, keys, partitions, declared, unnamed, heavy, stored)


def _read_in(session: SparkSession, written: DataFrame) -> DataFrame:
    """A written table, read by another session."""
    return session.read.schema(written.schema).parquet(*written.inputFiles())


#: a bucket is one file, written sorted, so a scan may count on its order
_BUCKETS = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}


def bucketed(rows: DataFrame, partitions: int, keys: list[str]) -> tuple[DataFrame, str]:
    """``rows``, which lie in ``partitions`` hash classes of ``keys``, as a table with one sorted file a class."""
    spark = rows.sparkSession
    path = fresh_path(spark, "placed")
    name = f"linkmill_{path.rsplit('-', 1)[-1]}"
    writer = rows.write.bucketBy(partitions, *keys).sortBy(*keys).option("path", path)
    writer.format("parquet").saveAsTable(name)
    return spark.table(name), name


def folded(declared: int, fitting: int) -> int:
    """Tasks for ``declared`` hash classes of which ``fitting`` tasks are filled.

    The largest divisor of ``declared`` that is no larger than ``fitting``: class c then lies in task
    c modulo that number, so rows that share a class share a task.  A number close to
    ``fitting``, or without a divisor near it, stays as it is.
    """
    if declared <= 2 * fitting:
        return declared
    divisor = next(n for n in range(fitting, 0, -1) if declared % n == 0)
    return divisor if 2 * divisor >= fitting else declared


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _fitting_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions that rows fill; the number grows with the graph, whatever the session's is."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PARTITION))


def init_ranks(edges: DataFrame, r0: float = RANK_START) -> DataFrame:
    """The same start rank for every source."""
    return edges.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(float(r0)))


def join_ranks(links: Links, ranks: DataFrame) -> DataFrame:
    """Links of the sources that have a rank, with that rank.

    The links are already placed and sorted by the join keys, so merging moves
    nothing but the ranks; a broadcast would only add a trip over the driver.
    """
    by_source = ranks.select(F.col("node").alias("src"), "rank")
    if links.heavy is not None:
        by_source = skew.copy_per_slice(by_source, "src", links.heavy)
    if links.partitions != _shuffle_partitions(ranks.sparkSession):
        # never let the planner move the links instead
        by_source = by_source.repartition(links.partitions, *links.keys)
    return links.rows.join(by_source.hint("merge"), links.keys)


def contributions(joined: DataFrame, *also: str | Column) -> DataFrame:
    """What each ranked source gives to each target."""
    return joined.select(F.col("dst").alias("node"), (F.col("weight") * F.col("rank")).alias("v"), *also)


def sum_contributions(given: DataFrame) -> DataFrame:
    """Total received per node."""
    return given.groupBy("node").agg(F.sum("v").alias("total"))


def damp(sums: DataFrame, base: float = RANK_BASE, factor: float = RANK_FACTOR, *also: str) -> DataFrame:
    """``base + factor * total`` as the next rank."""
    return sums.select("node", (F.lit(base) + F.lit(factor) * F.col("total")).alias("rank"), *also)
