"""Dense layers as Arrow-batched columns.

Weights are a broadcast variable, so a task receives them once; a batch is one
matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.functions.vectors import relu, softmax


def matrix(cells: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as a float64 matrix."""
    flat = cells.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(cells) * width:
        raise ValueError(f"expected {width} features per row")
    return flat.astype(np.float64).reshape(len(cells), width)


def affine(df: DataFrame, features: str, weights: np.ndarray, bias: np.ndarray) -> Column:
    """``x . W + b`` per row as an array of doubles."""
    shared = df.sparkSession.sparkContext.broadcast(
        (np.asarray(weights, float), np.asarray(bias, float).reshape(-1))
    )

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def product(cells: pa.Array) -> pa.Array:
        w, b = shared.value
        out = matrix(cells, w.shape[0]) @ w + b
        ends = np.arange(0, out.size + 1, w.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    return product(F.col(features))


def dense_layer(
    df: DataFrame,
    weights: np.ndarray,
    bias: np.ndarray,
    activation: str | None = None,
    features: str = "features",
    name: str = "activations",
) -> DataFrame:
    """One fully connected layer; ``activation`` is None, 'relu' or 'softmax'."""
    steps = {None: lambda z: z, "relu": relu, "softmax": softmax}
    if activation not in steps:
        raise ValueError(f"unknown activation {activation!r}")
    scored = df.withColumn("_z", affine(df, features, weights, bias))
    return scored.withColumn(name, steps[activation](F.col("_z"))).drop("_z")


def softmax_predict(
    df: DataFrame, weights: np.ndarray, bias: np.ndarray, features: str = "features", name: str = "probs"
) -> DataFrame:
    """Class probabilities per row."""
    return dense_layer(df, weights, bias, "softmax", features, name)
