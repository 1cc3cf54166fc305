"""Centroid clustering by tables of scalar squared differences.

A vector is stored as one index per dimension into the whole numbers that occur
in that dimension of its block; this is done once.  Each round tabulates, for every
dimension, occurring number and centroid, the squared difference; the distances of
a block are table rows gathered by index and added up.  Sums of members are
counts of each occurring number times that number.  Everything is exact in 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.vector_blocks import is_finite, moved, pack, totals, whole_numbers
from linkmill.plans.lineage import materialize

WIDTH, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, "3"
_BINARIES = ["values", "starts", "places"]


def _indexed(vectors: np.ndarray) -> dict[str, bytes]:
    """Occurring numbers of all dimensions, where each dimension's begin, and each cell's index."""
    values, places = [], np.empty(vectors.shape, "<u2")
    for k in range(vectors.shape[1]):
        found, places[:, k] = np.unique(vectors[:, k], return_inverse=True)
        values.append(found)
    starts = np.cumsum([0] + [len(v) for v in values])
    return {
        "values": np.concatenate(values).astype("<i4").tobytes(),
        "starts": starts.astype("<i4").tobytes(),
        "places": places.T.tobytes(),
    }


def _read(values: bytes, starts: bytes, places: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    begins = np.frombuffer(starts, "<i4").astype(np.int64)
    cells = np.frombuffer(places, "<u2").reshape(width, -1) + begins[:-1, None]
    return np.frombuffer(values, "<i4").astype(np.int64), begins, cells


def distances(values: np.ndarray, begins: np.ndarray, cells: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (vectors, centroids): rows gathered from the round's tables."""
    dims = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    step = values[:, None] - centres.T[dims]
    table = step * step
    far = np.zeros((cells.shape[1], len(centres)), np.int64)
    for row in cells:
        far += table[row]
    return far


def _sums(values: np.ndarray, begins: np.ndarray, cells: np.ndarray, nearest: np.ndarray, clusters: int) -> np.ndarray:
    """Rows ``count, sums`` of every cluster, from how often each number occurs in it."""
    out = np.zeros((clusters, len(cells) + 1), np.int64)
    out[:, 0] = np.bincount(nearest, minlength=clusters)
    for k, row in enumerate(cells):
        here = values[begins[k] : begins[k + 1]]
        times = np.bincount(nearest * len(here) + (row - begins[k]), minlength=clusters * len(here))
        out[:, k + 1] = times.reshape(clusters, -1) @ here
    return out


def cluster(table: DataFrame, vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors of exactly WIDTH components, none null or non-finite;
    components beyond 2**24 / SCALE count as that.  The first centroids are the
    kept vectors with the smallest SHA-256 of ``SEED:<vec_id>``, equal ids by their
    components, null ids last; fewer vectors than centroids give fewer centroids.
    Rows that repeat an id are rows of their own.  Other columns are not looked at; no
    rows, no result.
    """
    spark = table.sparkSession
    cells = whole_numbers(F.col(f"`{vector}`"), SCALE).alias("cells")
    kept = table.where(is_finite(F.col(f"`{vector}`")) & (F.size(f"`{vector}`") == WIDTH)).select("vec_id", cells)
    draw = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    head = kept.orderBy(F.isnull("vec_id"), draw, "cells").limit(clusters).collect()
    schema = T.StructType([kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    centres = np.array([r["cells"] for r in head], np.int64).reshape(len(head), WIDTH)
    if not head:
        none = spark.createDataFrame([], schema)
        zero = F.lit(0).cast("long")
        return none.select("*", zero.alias("cluster_inertia"), zero.alias("inertia"), F.lit("").alias("centroid_sha256"))
    blocks = pack(kept, WIDTH, _indexed, _BINARIES)

    def sums_under(now: np.ndarray):
        def of(*binaries: bytes) -> np.ndarray:
            block = _read(*binaries, WIDTH)
            return _sums(*block, distances(*block, now).argmin(axis=1), len(now))

        return of

    for _ in range(rounds):
        found = totals(blocks, _BINARIES, len(centres), 1 + WIDTH, sums_under(centres))
        centres = moved(centres, found[:, 0], found[:, 1:])
    names = [f.name for f in schema.fields]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                far = distances(*_read(*(batch.column(k)[i].as_py() for k in range(1, 4)), WIDTH), centres)
                nearest = far.argmin(axis=1)
                near = far[np.arange(len(far)), nearest]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i].values, pa.array(nearest.astype(np.int32)), pa.array(near)], names)

    placed = materialize(blocks.select("vec_id", *_BINARIES).mapInArrow(told, schema), "clusters")
    inertia = {r["cluster"]: r["inertia"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    of_cluster = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centres))])
    return placed.select(
        *names,
        F.get(of_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, hashes)), F.col("cluster")).alias("centroid_sha256"),
    )
