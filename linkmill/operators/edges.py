"""Link records: parsing, filtering and per-source shape.

Edges are a bag of ``(src, dst)``: repeated links are kept and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import COMMENT_PREFIX, KEPT_NAMESPACE
from linkmill.plans.lineage import materialize


def split_fields(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """Each line as an array of fields, empty trailing fields included."""
    pattern = sep if sep.isspace() else f"\\Q{sep}\\E"
    return lines.select(F.split("value", pattern).alias("fields"))


def drop_comments(lines: DataFrame, prefix: str = COMMENT_PREFIX) -> DataFrame:
    """Lines that are neither empty nor start with ``prefix``."""
    return lines.where((F.length("value") > 0) & ~F.startswith(F.col("value"), F.lit(prefix)))


def pick_target(fields: DataFrame, mode: str = "failfast") -> DataFrame:
    """``(src, dst)`` from the first two fields; further fields are ignored.

    A record with one field fails the job, or is left out in ``permissive``.
    """
    source, target = F.get("fields", F.lit(0)), F.get("fields", F.lit(1))
    if mode == "permissive":
        return fields.select(source.alias("src"), target.alias("dst")).where("dst IS NOT NULL")
    if mode != "failfast":
        raise ValueError(f"unknown mode {mode!r}")
    complaint = F.concat(F.lit("link record without a target: "), F.coalesce(source, F.lit("")))
    return fields.select(
        source.alias("src"), F.coalesce(target, F.raise_error(complaint).cast("string")).alias("dst")
    )


def parse_edges(
    lines: DataFrame, sep: str = "\t", comment_prefix: str | None = None, mode: str = "failfast"
) -> DataFrame:
    """Link records from lines of text."""
    if comment_prefix is not None:
        lines = drop_comments(lines, comment_prefix)
    return pick_target(split_fields(lines, sep), mode)


def keep_content_targets(edges: DataFrame) -> DataFrame:
    """Targets outside any namespace, or in the one kept namespace."""
    dst = F.col("dst")
    return edges.where(~F.contains(dst, F.lit(":")) | F.startswith(dst, F.lit(KEPT_NAMESPACE)))


def lower_fields(edges: DataFrame) -> DataFrame:
    """Both ends in lower case."""
    return edges.select(F.lower("src").alias("src"), F.lower("dst").alias("dst"))


def content_edges(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """Lines to lower-cased edges that pass the namespace filter."""
    return lower_fields(keep_content_targets(parse_edges(lines, mode=mode)))


def out_degree(edges: DataFrame) -> DataFrame:
    """Number of links per source, repeated links counted."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("n_links"))


def node_keys(edges: DataFrame) -> DataFrame:
    """The distinct sources."""
    return edges.select("src").distinct()


def count_sources(edges: DataFrame) -> int:
    """How many distinct sources there are."""
    return node_keys(edges).count()


def adjacency(edges: DataFrame, max_list: int = 100_000) -> DataFrame:
    """Targets per source as lists: ``(src, slice, dests)``.

    The edges are scanned once, into a table of counted links.  Those are sorted by
    source and target over all tasks, so a hub lies in as many tasks as it fills, and
    each task cuts its stretch into lists as it reads it: at a new source, and after
    ``max_list`` links of one.  No degree is looked up, and no task holds more
    than a list and a batch.  Rows of a source are told apart by ``slice``; a source that
    lies in two tasks has a list in each.  Copies of one link count one by one.
    """
    counted = materialize(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies")), "links")
    last = F.floor((F.col("copies") - 1) / F.lit(max_list)).cast("long")
    pieces = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    size = F.least(F.lit(max_list), F.col("copies") - F.col("piece") * max_list).cast("int")
    placed = pieces.orderBy("src", "dst", "piece").select("src", "dst", size.alias("n"))
    return placed.mapInArrow(_lists(max_list), "src string, slice long, dests array<string>")


def _lists(max_list: int):
    """Task function: sorted ``(src, dst, n)`` to lists of at most ``max_list`` targets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # lists of the task's first source are numbered apart: the task before may have some, too
        held, number = None, TaskContext.get().partitionId() << 32
        for whole in batches:
            for rows in _stretches(whole, max(max_list, _EXPANDED)):
                links = np.repeat(np.arange(rows.num_rows), rows.column("n").to_numpy())
                src, dst = rows.column("src").take(links), rows.column("dst").take(links)
                if held is not None:
                    src, dst = (pa.concat_arrays([a, b]) for a, b in zip(held, (src, dst), strict=True))
                new = np.ones(len(src), bool)
                new[1:] = pc.not_equal(src[1:], src[:-1]).to_numpy(zero_copy_only=False)
                begins = np.flatnonzero(new)
                offset = np.arange(len(src)) - np.repeat(begins, np.diff(np.append(begins, len(src))))
                starts = np.flatnonzero(offset % max_list == 0)
                first = np.searchsorted(starts, begins[1], "left") if len(begins) > 1 else len(starts)
                slices = offset[starts] // max_list
                slices[:first] += number
                if len(starts) > 1:
                    lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), dst[: starts[-1]])
                    done = pa.array(slices[:-1])
                    yield pa.RecordBatch.from_arrays([src.take(starts[:-1]), done, lists], ["src", "slice", "dests"])
                held, number = (src[starts[-1] :], dst[starts[-1] :]), int(slices[-1])
        if held is not None:
            lists = pa.ListArray.from_arrays(pa.array([0, len(held[1])], pa.int32()), held[1])
            yield pa.RecordBatch.from_arrays([held[0][:1], pa.array([number]), lists], ["src", "slice", "dests"])

    return run


#: links that are written out at once
_EXPANDED = 200_000


def _stretches(rows: pa.RecordBatch, links: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about that many links."""
    upto = np.cumsum(rows.column("n").to_numpy(), dtype=np.int64)
    begin = 0
    while begin < rows.num_rows:
        before = upto[begin - 1] if begin else 0
        end = max(int(np.searchsorted(upto, before + links, "right")), begin + 1)
        yield rows.slice(begin, end - begin)
        begin = end
