"""Mini-batches read from their own files.

Rows are written once, in order and in folders by range of their position.  The batch of a
step is one stretch of positions (two where it runs on over the end of the
rows), so a step lists the folders that hold it and reads no other file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.operators.order import stream_places, with_row_index
from linkmill.plans.lineage import fresh_path

#: folders of a store at most; a larger table has longer ranges, of which a step then reads one or two
MAX_RANGES = 4096
RANGE = "row_range"


@dataclass(frozen=True)
class BatchStore:
    """Ordered rows with ``row_index``, stored in folders of ``width`` positions."""

    rows: DataFrame
    total: int
    width: int

    def stretches(self, batch: int, step: int) -> list[tuple[int, int]]:
        """First and last position of the rows in a batch of the endless stream of rows."""
        if not self.total:
            return []
        if batch >= self.total:
            return [(0, self.total - 1)]
        begin = batch * step % self.total
        end = begin + batch
        if end <= self.total:
            return [(begin, end - 1)]
        return [(begin, self.total - 1), (0, end - self.total - 1)]

    def batch(self, batch: int, step: int) -> DataFrame:
        """Rows of a step with their place in the batch, ``_place``; rows that are in it twice come twice."""
        index, folder = F.col("row_index"), F.col(RANGE)
        folders, rows = F.lit(False), F.lit(False)
        for first, last in self.stretches(batch, step):
            folders = folders | folder.between(first // self.width, last // self.width)
            rows = rows | index.between(first, last)
        places = stream_places(batch, max(self.total, 1), step)
        return self.rows.where(folders).where(rows).withColumn("_place", F.explode(places))


def store_batches(df: DataFrame, batch: int, *order: str, max_ranges: int = MAX_RANGES) -> BatchStore:
    """Write ``df`` in the given order for batches of ``batch`` rows."""
    indexed = with_row_index(df, *order)
    total = indexed.count()
    width = max(batch, -(-total // max_ranges), 1)
    path = fresh_path(df.sparkSession, "batches")
    placed = indexed.withColumn(RANGE, F.floor(F.col("row_index") / F.lit(width)).cast("long"))
    placed.write.partitionBy(RANGE).parquet(path)
    return BatchStore(df.sparkSession.read.schema(placed.schema).parquet(path), total, width)
