"""Softmax training, evaluation and saved parameters.

Rows stay on the executors; the driver holds the parameters and, per step,
receives one number per parameter.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.fixed_values import (
    DECAYED_GROUPS,
    DEFAULT_MOMENTUM,
    DEFAULT_RATE,
    FULL_BATCH_EPOCHS,
    FULL_BATCH_RATE,
    SAVE_EVERY,
)
from linkmill.functions.layers import softmax_predict
from linkmill.functions.schedule import exp_decay_at
from linkmill.operators.gradient import step_sums
from linkmill.operators.metrics import top1_accuracy
from linkmill.operators.order import assign_replicas
from linkmill.plans.batch_store import BatchStore, store_batches

_TRACE = "step int, loss double, cell_accuracy double, top1_accuracy double, rows long, seconds double"
_PARAMS = "var string, idx long, value double"
#: the part of rows that only score
_HELD_OUT = -1


@dataclass
class Params:
    """Weights ``[features, classes]`` and one bias per class."""

    weights: np.ndarray
    biases: np.ndarray

    @staticmethod
    def start(width: int, classes: int, init: str = "zeros", seed: int = 0) -> Params:
        if init == "zeros":
            return Params(np.zeros((width, classes)), np.zeros(classes))
        if init != "normal":
            raise ValueError(f"unknown init {init!r}")
        draw = np.random.default_rng(seed)
        return Params(draw.standard_normal((width, classes)), draw.standard_normal(classes))

    def table(self, spark: SparkSession) -> DataFrame:
        """``(var, idx, value)``."""
        rows = [("weights", i, float(v)) for i, v in enumerate(self.weights.ravel())]
        rows += [("biases", i, float(v)) for i, v in enumerate(self.biases)]
        return spark.createDataFrame(rows, _PARAMS)


@dataclass
class Trained:
    """Final parameters and the trace of a run."""

    params: Params
    trace: list[tuple] = field(default_factory=list)

    def trace_table(self, spark: SparkSession) -> DataFrame:
        """Step 0 is the start; step t has the loss before and the accuracies after update t.

        ``rows`` and ``seconds`` are those of the step's own pass.
        """
        return spark.createDataFrame(self.trace, _TRACE)


@dataclass
class Momentum:
    """Momentum with one decayed rate per parameter group."""

    total_steps: float
    groups: tuple = DECAYED_GROUPS
    nesterov: bool = False

    def setting(self, name: str, step: int) -> tuple[float, float]:
        """Rate and momentum of a variable: exact name, else first matching pattern, else default."""
        exact = [g for g in self.groups if g[0] == name]
        for _, start, target, stairs, momentum in exact + [g for g in self.groups if re.search(g[0], name)]:
            return exp_decay_at(step, start, target, stairs, self.total_steps), momentum
        return DEFAULT_RATE, DEFAULT_MOMENTUM


def _update(params: Params, state: dict, grads: dict, step: int, lr: float, rule: Momentum | None):
    new = {}
    for name in ("weights", "biases"):
        value, g = getattr(params, name), grads[name]
        if rule is None:
            new[name] = value - lr * g
            continue
        rate, mom = rule.setting(name, step)
        state[name] = mom * state.get(name, 0.0) + g
        push = g + mom * state[name] if rule.nesterov else state[name]
        new[name] = value - rate * push
    return Params(**new)


class _AllRows:
    """Every step sees all rows, kept by the executors."""

    def __init__(self, rows: DataFrame, held: DataFrame | None):
        self.rows = (rows if held is None else rows.unionByName(held)).persist()

    def at(self, step: int) -> DataFrame:
        return self.rows

    def close(self) -> None:
        self.rows.unpersist()


class _Batches:
    """Every step reads its own batch, and the held-out rows, kept by the executors."""

    def __init__(self, store: BatchStore, batch: int, replicas: int, features: str, label: str, held: DataFrame | None):
        self.store, self.batch, self.replicas = store, batch, replicas
        self.columns = [features, label, "_part"]
        self.held = None if held is None else held.persist()

    def at(self, step: int) -> DataFrame:
        stretch = F.floor(F.col("_place") * self.replicas / self.batch).cast("int")
        fed = self.store.batch(self.batch, step).withColumn("_part", stretch).select(*self.columns)
        return fed if self.held is None else fed.unionByName(self.held)

    def close(self) -> None:
        if self.held is not None:
            self.held.unpersist()


def train_softmax(
    df: DataFrame,
    classes: int,
    epochs: int = FULL_BATCH_EPOCHS,
    lr: float = FULL_BATCH_RATE,
    init: str = "zeros",
    seed: int = 0,
    features: str = "features",
    label: str = "label",
    eval_df: DataFrame | None = None,
    batch: int | None = None,
    replicas: int | None = None,
    order: list[str] | None = None,
    momentum: Momentum | None = None,
    decay: float | None = None,
    save_to: str | None = None,
    save_every: int = SAVE_EVERY,
    start: Params | None = None,
    equal: bool = True,
) -> Trained:
    """Softmax regression by gradient descent, one Spark job per step.

    Full batch by default.  ``batch`` feeds consecutive mini-batches of the rows
    repeated without end (``epochs`` then counts batches), so a batch may run
    over into the next epoch and none is short; ``replicas`` splits the rows into
    equal parts whose gradients are averaged (parts that need not be ``equal`` by their rows), with
    ``batch`` each batch into stretches whose gradients are averaged by their rows; both need ``order``
    columns that place the rows.  ``decay`` adds the L2 term of the weights to
    loss and gradient.  ``start`` gives the first parameters instead of ``init``.
    """
    needed = list(dict.fromkeys([features, label, *(order or [])]))
    rows = df.select(*needed)
    held = None if eval_df is None else eval_df.select(features, label, F.lit(_HELD_OUT).alias("_part"))
    if batch:
        feed = _Batches(store_batches(rows, batch, *order), batch, replicas or 1, features, label, held)
    else:
        if replicas:
            rows = assign_replicas(rows, replicas, *order, equal=equal).withColumnRenamed("replica_id", "_part")
        else:
            rows = rows.withColumn("_part", F.lit(0))
        feed = _AllRows(rows.select(features, label, "_part"), held)
    try:
        params, state = start, {}
        if params is None:
            params = Params.start(len(df.select(features).first()[0]), classes, init, seed)
        trace, losses = [], []
        for step in range(epochs + 1):
            began = time.monotonic()
            found = step_sums(feed.at(step), params.weights, params.biases, features, label, F.col("_part"))
            held_out = found.pop(_HELD_OUT, None)
            fed = sum(p["rows"] for p in found.values())
            mean = _mean_of_parts(found)
            if decay:
                mean["loss"] += decay * float((params.weights**2).sum()) / 2
                mean["weights"] = mean["weights"] + decay * params.weights
            losses.append(mean["loss"])
            score = held_out or mean
            reached = (losses[max(step - 1, 0)], score["cell_accuracy"], score["top1_accuracy"])
            trace.append((step, *map(float, reached), fed, time.monotonic() - began))
            if step < epochs:
                params = _update(params, state, mean, step, lr, momentum)
                if save_to and (step % save_every == 0 or step + 1 == epochs):
                    save_params(df.sparkSession, params, save_to, step)
    finally:
        feed.close()
    return Trained(params, trace)


def _mean_of_parts(found: dict[int, dict]) -> dict:
    """Mean over replicas by their rows; with one part, that part."""
    parts = list(found.values())
    rows = sum(p["rows"] for p in parts)
    keys = ("loss", "cell_accuracy", "top1_accuracy", "weights", "biases")
    return {k: sum(p[k] * (p["rows"] / rows) for p in parts) for k in keys}


def save_params(spark: SparkSession, params: Params, path: str, step: int) -> None:
    """Write the parameters of one step below ``path``."""
    params.table(spark).coalesce(1).write.parquet(f"{path.rstrip('/')}/step={step}")


def load_params(spark: SparkSession, path: str, step: int | None = None) -> tuple[int, Params]:
    """Parameters of the given or latest saved step."""
    saved = spark.read.parquet(path)
    if step is None:
        step = saved.agg(F.max("step")).first()[0]
    rows = saved.where(F.col("step") == step).orderBy("var", "idx").collect()
    biases = np.array([r["value"] for r in rows if r["var"] == "biases"])
    weights = np.array([r["value"] for r in rows if r["var"] == "weights"])
    return step, Params(weights.reshape(-1, len(biases)), biases)


def evaluate(
    df: DataFrame, path: str, step: int | None = None, features: str = "features", label: str = "label"
) -> DataFrame:
    """Precision of saved parameters over the rows: ``(step, correct, total, precision)``."""
    step, params = load_params(df.sparkSession, path, step)
    probs = softmax_predict(df, params.weights, params.biases, features)
    return top1_accuracy(probs, "probs", label).withColumn("step", F.lit(step))


__all__ = [
    "Momentum",
    "Params",
    "Trained",
    "evaluate",
    "load_params",
    "save_params",
    "train_softmax",
]
