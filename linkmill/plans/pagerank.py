"""Iterative link ranking.

The links move once, to the hash class of their source.  The first round goes with the exchange of names;
the others send plain arrays of sums between the classes (``operators/rank_blocks``), one
shuffle a round.  Where heavy sources are sliced, all rounds are joins: the cached link table is
already partitioned and sorted by source, and the ranks leave the previous aggregate partitioned by
node, so the join adds no exchange; the aggregate by target is the only shuffle, after a
map-side combine.  The rounds are planned in a session of the links' own, for the
number of partitions that they have, whatever the caller's is.  (When heavy sources are sliced, the
ranks - one row per node - are shuffled once more.)
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.fixed_values import (
    COMMENT_PREFIX,
    FIRST_LINES,
    LINK_PARTITIONS,
    NORMALISED_TELEPORT,
    RANK_BASE,
    RANK_FACTOR,
    RANK_ITERATIONS,
    RANK_START,
)
from linkmill.operators import rank_blocks as B
from linkmill.operators.edges import content_edges, parse_edges
from linkmill.operators.rank import (
    MIN_SLICE_ROWS,
    Links,
    bucketed,
    contributions,
    damp,
    init_ranks,
    join_ranks,
    link_table,
    sum_contributions,
)
from linkmill.plans.lineage import checkpoint, moved_to, scratch, swept
from linkmill.sources.text import first_lines


def pagerank(
    edges: DataFrame,
    iterations: int = RANK_ITERATIONS,
    sources: str = "drop",
    base: float = RANK_BASE,
    factor: float = RANK_FACTOR,
    r0: float = RANK_START,
    normalise: bool = False,
    cache_links: bool = True,
    num_partitions: int | None = None,
    checkpoint_every: int = 2,
    min_slice_rows: int = MIN_SLICE_ROWS,
) -> DataFrame:
    """Rank the nodes of ``edges (src, dst)``; returns ``(node, rank)``.

    With ``normalise`` the base is ``a/N`` and the factor ``1-a``, where N is
    the number of distinct sources.  The result is written, so reading it again
    does not run the rounds again.  ``num_partitions`` declares hash classes of the links; few rows are
    folded into fewer tasks.
    """
    if iterations < 1:
        return init_ranks(edges, r0)
    one = iterations == 1
    with scratch(edges.sparkSession):
        # blocks are cut in one scan of the links, which need not be held for that
        links = link_table(
            edges, sources, num_partitions, cache_links, min_slice_rows, self_links=one, held=one or normalise
        )
        try:
            with swept(links.rows.sparkSession):
                if normalise and (n_sources := links.n_sources()):
                    base, factor = NORMALISED_TELEPORT / n_sources, 1 - NORMALISED_TELEPORT
                how = (base, factor, sources == "keep")
                if one or links.heavy is not None:
                    ranks = _rounds(links, iterations, base, factor, r0, checkpoint_every)
                    return moved_to(edges.sparkSession, ranks, "ranks")
                built = _built(links, r0, *how)
        finally:
            links.release()
    # the blocks hold all that rounds need: the links are gone by now
    rounds = _block_rounds(built, links.partitions, iterations, checkpoint_every, cache_links, *how)
    with swept(built.sparkSession), rounds as ranks:
        return moved_to(edges.sparkSession, ranks, "ranks")


def _rounds(
    links: Links, iterations: int, base: float, factor: float, r0: float, checkpoint_every: int
) -> DataFrame:
    # all sources start equal, so the first round needs no join
    ranks = damp(
        sum_contributions(contributions(links.rows.withColumn("rank", F.lit(float(r0))))), base, factor
    )
    for done in range(1, iterations):
        if done % checkpoint_every == 0:
            ranks = checkpoint(ranks)
        ranks = damp(sum_contributions(contributions(join_ranks(links, ranks))), base, factor)
    return ranks


def _built(links: Links, r0: float, base: float, factor: float, keep: bool) -> DataFrame:
    """Blocks, names and the ranks after one round."""
    # a session that plans for another number may have put the links elsewhere
    scattered = int(links.rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) != links.partitions
    # all sources start equal, so the first round is summed up where the links lie
    cut = B.cut_blocks(links.rows, None, links.partitions, r0, scattered)
    return checkpoint(B.build_blocks(cut, base, factor, keep))


@contextmanager
def _block_rounds(
    built: DataFrame,
    partitions: int,
    iterations: int,
    checkpoint_every: int,
    cache_blocks: bool,
    base: float,
    factor: float,
    keep: bool,
) -> Iterator[DataFrame]:
    """Ranks after ``iterations`` rounds; the blocks are held as long as the ranks are read."""
    blocks = B.of_kind(built, "block").repartition(partitions, "to")
    stored = None
    if not cache_blocks:
        blocks, stored = bucketed(blocks, partitions, ["to"])
    else:
        blocks = blocks.persist()
        blocks.count()
    state = B.of_kind(built, "ranks")
    how = (base, factor, keep)
    try:
        for done in range(1, iterations):
            if (done - 1) % checkpoint_every == 0:
                sums = B.block_step(blocks, state, "sums", *how)
            cut = done % checkpoint_every == 0
            if cut or done == iterations - 1:
                state = B.block_step(blocks, sums, "ranks", *how)
                state = checkpoint(state) if done < iterations - 1 else state
            else:
                sums = B.block_step(blocks, sums, "sums", *how)
        yield B.named_ranks(B.of_kind(built, "names"), state)
    finally:
        blocks.unpersist()
        if stored:
            blocks.sparkSession.sql(f"DROP TABLE IF EXISTS {stored}")


def raw_pagerank(lines: DataFrame, **options) -> DataFrame:
    """Ranking of a plain link file: comment lines skipped, nothing folded."""
    return pagerank(parse_edges(lines, comment_prefix=COMMENT_PREFIX), **options)


def wiki_pagerank(lines: DataFrame, **options) -> DataFrame:
    """Ranking of encyclopedia links: namespace filter, then lower case."""
    return pagerank(content_edges(lines), **options)


def sample_pagerank(spark: SparkSession, path: str, n: int = FIRST_LINES, **options) -> DataFrame:
    """Normalised ranking of the first ``n`` lines of the input."""
    return wiki_pagerank(first_lines(spark, path, n), normalise=True, **options)


def partitioned_pagerank(
    lines: DataFrame, num_partitions: int = LINK_PARTITIONS, **options
) -> DataFrame:
    """Encyclopedia ranking with the links in a given number of partitions."""
    return wiki_pagerank(lines, num_partitions=num_partitions, **options)


def partition_report(before: DataFrame, partitions: int, links: Links) -> DataFrame:
    """Partitions, those in use, rows and largest partition, before and after placing.

    ``before`` lies in ``partitions`` partitions; empty ones count.  After placing, partitions are
    the hash classes that were declared, however many of them share a task.
    """

    def report(stage: str, df: DataFrame, declared: int, place: Column) -> DataFrame:
        filled = df.groupBy(place.cast("long").alias("id")).agg(F.count(F.lit(1)).alias("n"))
        every = df.sparkSession.range(declared).join(filled, "id", "left")
        return every.agg(
            F.count(F.lit(1)).alias("partitions"),
            F.count("n").alias("used"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.max("n"), F.lit(0)).alias("largest"),
        ).select(F.lit(stage).alias("stage"), "partitions", "used", "n_rows", "largest")

    hash_class = F.pmod(F.hash(*links.keys), F.lit(links.declared))
    placed = report("after", links.rows, links.declared, hash_class)
    return report("before", before, partitions, F.spark_partition_id()).unionByName(placed)
