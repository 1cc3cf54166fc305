"""Softmax gradients and parameter updates over distributed rows.

Parameters as a table are ``(var, idx, value)`` with ``var`` 'weights' or
'biases'; element (i, k) of the weights has ``idx = i * classes + k``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.functions.layers import matrix

_LOSS, _CELLS, _TOP1 = range(3)
_STATS = 3
#: numbers of a part that travel together: one reducing task holds one such piece of each input task
CHUNK = 8192
_PARTIAL = "part int, chunk int, s array<double>"


def _partial_sums(shared, width: int, classes: int):
    """Per task: sums over its rows of the row statistics and the gradient."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        sums: dict[int, tuple] = {}
        for batch in batches:
            x = matrix(batch.column(0), width)
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = batch.column(2).to_numpy(zero_copy_only=False)
            z = x @ weights + bias
            z -= z.max(axis=1, keepdims=True)
            exps = np.exp(z)
            total = exps.sum(axis=1, keepdims=True)
            p = exps / total
            target = np.zeros_like(p)
            target[np.arange(len(y)), y] = 1.0
            loss = np.log(total[:, 0]) - (z * target).sum(axis=1)
            cells = (np.rint(p) == target).mean(axis=1)
            top1 = (p * target).sum(axis=1) >= p.max(axis=1)
            error = p - target
            for part in np.unique(parts):
                mine = parts == part
                stats = [loss[mine].sum(), cells[mine].sum(), top1[mine].sum()]
                new = np.concatenate([stats, (x[mine].T @ error[mine]).ravel(), error[mine].sum(axis=0)])
                rows, total = sums.get(int(part), (0, 0.0))
                sums[int(part)] = (rows + int(mine.sum()), total + new)
        for part, (rows, total) in sums.items():
            for chunk, at in enumerate(range(0, len(total), CHUNK)):
                yield _piece(part, chunk, np.concatenate([[rows], total[at : at + CHUNK]]))

    return run


def _piece(part: int, chunk: int, values: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), lists], names=["part", "chunk", "s"]
    )


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One piece of a part, summed over the input tasks as they arrive."""
    total = 0.0
    for batch in batches:
        pieces = batch.column(batch.schema.get_field_index("s"))
        total = total + pieces.flatten().to_numpy().reshape(len(pieces), -1).sum(axis=0)
    yield _piece(key[0].as_py(), key[1].as_py(), total)


def _share(df: DataFrame, weights: np.ndarray, bias: np.ndarray):
    return df.sparkSession.sparkContext.broadcast((weights, np.asarray(bias).reshape(-1)))


def task_sums(df: DataFrame, shared, shape: tuple, features: str, label: str, part: Column) -> DataFrame:
    """``(part, chunk, s)``: per task and part its sums, cut into pieces.

    The numbers of a part are row statistics, weights and biases, one after another;
    every piece holds the part's rows first, then at most CHUNK of them.
    """
    width, classes = shape
    narrow = df.select(features, F.col(label).cast("int"), part.cast("int"))
    return narrow.mapInArrow(_partial_sums(shared, width, classes), _PARTIAL)


def _sums(df: DataFrame, shared, shape: tuple, features: str, label: str, part: Column) -> DataFrame:
    """``(part, chunk, s)`` summed over all tasks; every piece is added up by a task of its own."""
    partial = task_sums(df, shared, shape, features, label, part)
    return partial.groupBy("part", "chunk").applyInArrow(_added, _PARTIAL)


def _means(sums: DataFrame, size: int, classes: int) -> DataFrame:
    """Sums divided by the rows of their part, as ``(part, var, idx, g, rows)``."""
    n_weights = size * classes
    rows = F.get("s", F.lit(0)).alias("_rows")
    cells = sums.select("part", "chunk", rows, F.posexplode("s").alias("_at", "_sum")).where("_at > 0")
    place = F.col("chunk").cast("long") * CHUNK + F.col("_at") - 1 - _STATS
    var = F.when(place < n_weights, F.lit("weights")).otherwise(F.lit("biases"))
    at = F.when(place < n_weights, place).otherwise(place - n_weights)
    mean = (F.col("_sum") / F.col("_rows")).alias("g")
    rows = F.col("_rows").cast("long").alias("rows")
    return cells.where(place >= 0).select("part", var.alias("var"), at.alias("idx"), mean, rows)


def softmax_gradient(
    df: DataFrame,
    weights: np.ndarray,
    bias: np.ndarray,
    features: str = "features",
    label: str = "label",
    replica: str | None = None,
) -> DataFrame:
    """Gradient of the mean cross entropy: ``(var, idx, g)``.

    With ``replica`` there is one gradient per replica, in column ``replica``, beside the
    replica's ``rows``.
    """
    part = F.lit(0) if replica is None else F.col(replica)
    sums = _sums(df, _share(df, weights, bias), weights.shape, features, label, part)
    means = _means(sums, *weights.shape).withColumnRenamed("part", "replica")
    return means if replica else means.drop("replica", "rows")


def step_sums(
    df: DataFrame, weights: np.ndarray, bias: np.ndarray, features: str, label: str, part: Column
) -> dict[int, dict]:
    """One pass: per part its gradient, mean loss, accuracies and row count.

    What reaches the driver is one number per parameter and part.
    """
    width, classes = weights.shape
    shared = _share(df, weights, bias)
    table = _sums(df, shared, weights.shape, features, label, part).toArrow()
    shared.destroy()
    pieces: dict[int, dict[int, np.ndarray]] = {}
    for number, chunk, s in zip(*(table.column(c).to_pylist() for c in ("part", "chunk", "s")), strict=True):
        pieces.setdefault(number, {})[chunk] = np.array(s)
    out = {}
    for number, found in pieces.items():
        rows = found[0][0]
        means = np.concatenate([found[chunk][1:] for chunk in sorted(found)]) / rows
        out[number] = {
            "rows": int(rows),
            "loss": means[_LOSS],
            "cell_accuracy": means[_CELLS],
            "top1_accuracy": means[_TOP1],
            "weights": means[_STATS : _STATS + width * classes].reshape(width, classes),
            "biases": means[_STATS + width * classes :],
        }
    return out


def gradient_step(params: DataFrame, grads: DataFrame, lr: float) -> DataFrame:
    """``value - lr * g`` for each element."""
    joined = params.join(grads, ["var", "idx"])
    return joined.select("var", "idx", (F.col("value") - F.lit(lr) * F.col("g")).alias("value"))


def momentum_step(
    params: DataFrame,
    velocity: DataFrame | None,
    grads: DataFrame,
    lr: float | Column,
    momentum: float | Column,
    nesterov: bool = False,
    sparse: bool = False,
) -> DataFrame:
    """``v = momentum * v + g``, ``value -= lr * v``: ``(var, idx, value, v)``.

    ``lr`` and ``momentum`` may be expressions over ``var`` (see
    ``functions.schedule.pick_setting``).  With ``sparse`` the gradients cover
    only some elements, summed if listed twice; the others stay as they are.
    """
    lr = F.lit(lr) if not isinstance(lr, Column) else lr
    momentum = F.lit(momentum) if not isinstance(momentum, Column) else momentum
    state = params.select("var", "idx", "value")
    if velocity is None:
        state = state.withColumn("v", F.lit(0.0))
    else:
        state = state.join(velocity.select("var", "idx", "v"), ["var", "idx"], "left")
        state = state.withColumn("v", F.coalesce("v", F.lit(0.0)))
    if sparse:
        grads = grads.groupBy("var", "idx").agg(F.sum("g").alias("g"))
    joined = state.join(grads.select("var", "idx", "g"), ["var", "idx"], "left" if sparse else "inner")
    moved = momentum * F.col("v") + F.col("g")
    push = F.col("g") + momentum * moved if nesterov else moved
    hit = F.col("g").isNotNull()
    return joined.select(
        "var",
        "idx",
        F.when(hit, F.col("value") - lr * push).otherwise(F.col("value")).alias("value"),
        F.when(hit, moved).otherwise(F.col("v")).alias("v"),
    )
