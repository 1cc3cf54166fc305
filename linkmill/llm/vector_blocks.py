"""Vectors as whole numbers, packed into blocks that several rounds read.

A block is one row of a written table: at most BLOCK vectors with their columns
as lists, and whatever an operator builds over them once (a tree, a dictionary).
Rounds read that table, so nothing is parsed or built twice, and a lost executor
costs the tasks it ran.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.plans.lineage import materialize

#: vectors in a block
BLOCK = 16_384
#: whole numbers beyond this count as this, so that squares and their sums fit in 64 bits
LARGEST = 1 << 24


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component as array<int>, cut off at LARGEST."""

    def cell(x: Column) -> Column:
        scaled = F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
        return F.floor(scaled).cast("int")

    return F.transform(vector, cell)


def is_finite(vector: Column) -> Column:
    """A vector that is not null and holds neither null, NaN nor an infinity."""
    lowest, highest = F.lit(float("-inf")), F.lit(float("inf"))

    def plain(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (x > lowest) & (x < highest)

    return vector.isNotNull() & F.coalesce(F.forall(vector, plain), F.lit(False))


def pack(
    rows: DataFrame, width: int, built: Callable[[np.ndarray], dict[str, bytes]], names: list[str], block: int = BLOCK
) -> DataFrame:
    """Blocks of ``rows`` as a written table: a list per column but the last, and ``built``'s binaries.

    The last column of ``rows`` holds the vectors as array<int> of ``width``;
    ``built`` gets them as an int64 matrix and returns the binaries ``names``.
    """
    fields = rows.schema.fields[:-1]
    schema = T.StructType(
        [T.StructField(f.name, T.ArrayType(f.dataType)) for f in fields]
        + [T.StructField(name, T.BinaryType()) for name in names]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flushed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            cells = table.column(table.num_columns - 1).combine_chunks()
            vectors = cells.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)
            made = built(vectors)
            lists = []
            for field, column in zip(fields, table.columns, strict=False):
                values = column.combine_chunks()
                values = values if isinstance(values, pa.Array) else values.chunk(0)
                lists.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            binaries = [pa.array([made[name]], pa.binary()) for name in names]
            return pa.RecordBatch.from_arrays(lists + binaries, [f.name for f in fields] + names)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block - sum(b.num_rows for b in held))
                held.append(part)
                at += part.num_rows
                if sum(b.num_rows for b in held) == block:
                    yield flushed()
        if held:
            yield flushed()

    return materialize(rows.mapInArrow(run, schema), "blocks")


def totals(blocks: DataFrame, names: list[str], slots: int, width: int, of: Callable[..., np.ndarray]) -> np.ndarray:
    """``of(*binaries)`` summed over all blocks: an int64 matrix of ``slots`` rows and ``width`` columns.

    Tasks add up their own blocks; what reaches the driver is that one matrix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((slots, width), np.int64)
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                total += of(*row)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "total"])

    sums = blocks.select(*names).mapInArrow(run, "at long, total long").groupBy("at").agg(F.sum("total").alias("total"))
    out = np.zeros(slots * width, np.int64)
    found = sums.toArrow()
    out[found.column("at").to_numpy()] = found.column("total").to_numpy()
    return out.reshape(slots, width)


def moved(centres: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Every centre with members at the componentwise floor of their mean; the others as they are."""
    mean = sums // np.maximum(counts, 1)[:, None]
    return np.where(counts[:, None] > 0, mean, centres)
