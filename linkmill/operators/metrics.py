"""Losses, accuracies and summaries as plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import WEIGHT_DECAY
from linkmill.functions.vectors import array_total, log_sum_exp, one_hot


def cross_entropy(df: DataFrame, logits: str = "logits", label: str = "label") -> DataFrame:
    """Mean of ``-log p[label]``, taken from the logits so it stays finite."""
    z = F.col(logits)
    own = F.get(z, F.col(label))
    return df.agg(F.avg(log_sum_exp(z) - own).alias("loss"))


def cell_matches(probabilities: Column, target: Column) -> Column:
    """Share of cells of one row whose rounded value equals the target.

    Rounds half to even.
    """
    hits = F.zip_with(probabilities, target, lambda p, y: (F.rint(p) == y).cast("double"))
    return array_total(hits) / F.size(probabilities)


def cell_accuracy(df: DataFrame, classes: int, probs: str = "probs", label: str = "label") -> DataFrame:
    """Mean of :func:`cell_matches` over all rows."""
    share = cell_matches(F.col(probs), one_hot(F.col(label), classes))
    return df.agg(F.avg(share).alias("cell_accuracy"))


def top1_accuracy(df: DataFrame, probs: str = "probs", label: str = "label") -> DataFrame:
    """Share of rows whose label has the highest score; ties count as correct."""
    hit = F.get(probs, F.col(label)) == F.array_max(probs)
    return df.agg(
        F.sum(hit.cast("long")).alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.avg(hit.cast("double")).alias("precision"),
    )


def l2_penalty(weights: DataFrame, decay: float = WEIGHT_DECAY) -> DataFrame:
    """``decay * sum(w^2) / 2`` over the weights; biases are left out."""
    w = F.col("value")
    only = weights.where(~F.col("var").rlike("biases"))
    return only.agg((F.lit(decay) * F.coalesce(F.sum(w * w), F.lit(0.0)) / 2).alias("penalty"))


def average_gradients(grads: DataFrame, rows: str | None = None) -> DataFrame:
    """Mean over replicas per variable element of ``(replica, var, idx, g)``.

    ``rows`` names the column with the rows of the replica, which then weigh its gradient:
    the mean over replicas of unequal size is that over their rows.
    """
    mean = F.avg("g") if rows is None else F.sum(F.col("g") * F.col(rows)) / F.sum(rows)
    return grads.groupBy("var", "idx").agg(mean.alias("g"))


def column_summary(df: DataFrame, columns: list[str], bins: int | None = None) -> DataFrame:
    """Mean, population deviation, max and min per column, one pass.

    With ``bins`` a second pass adds the bins of :func:`column_histogram` in order, as
    ``histogram array<(bin, low, high, n)>``.
    """
    measures = []
    for c in columns:
        v = F.col(c).cast("double")
        parts = [
            F.lit(c).alias("column"),
            F.avg(v).alias("mean"),
            F.stddev_pop(v).alias("stddev"),
            F.max(v).alias("max"),
            F.min(v).alias("min"),
        ]
        measures.append(F.struct(*parts))
    summary = df.agg(F.array(*measures).alias("all")).select(F.inline("all"))
    if not bins:
        return summary
    each = column_histogram(df, columns, bins).groupBy("column")
    lists = each.agg(F.array_sort(F.collect_list(F.struct("bin", "low", "high", "n"))).alias("histogram"))
    return summary.join(lists, "column", "left")


def column_histogram(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Exact counts in ``bins`` equally wide bins per column: ``(column, bin, low, high, n)``.

    The first pass finds each column's range, the second counts.  A bin holds its lower
    edge, the last one its upper edge as well; empty bins have 0.  Null, NaN and infinite values
    are left out; equal values are all in bin 0; a column without values has no bins.
    """
    plain = {c: _finite(F.col(f"`{c}`").cast("double")) for c in columns}
    found = df.agg(*[f(plain[c]).alias(f"{f.__name__}_{i}") for i, c in enumerate(columns) for f in (F.min, F.max)]).first()
    ranges = {c: (found[f"min_{i}"], found[f"max_{i}"]) for i, c in enumerate(columns) if found[f"min_{i}"] is not None}
    spots, edges = [], []
    for c, (low, high) in ranges.items():
        at = F.lit(0)
        if high > low:
            share = (plain[c] - F.lit(low)) / F.lit(high - low)
            at = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
        spots.append(F.struct(F.lit(c).alias("column"), F.when(plain[c].isNotNull(), at).alias("bin")))
        step = (high - low) / bins
        edges += [(c, i, low + i * step, high if i == bins - 1 else low + (i + 1) * step) for i in range(bins)]
    grid = df.sparkSession.createDataFrame(edges, "column string, bin int, low double, high double")
    if not spots:
        return grid.withColumn("n", F.lit(0).cast("long"))
    counts = df.select(F.inline(F.array(*spots))).where("bin IS NOT NULL").groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    # one row per column and bin on either side
    return grid.join(F.broadcast(counts), ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def _finite(v: Column) -> Column:
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def throughput(trace: DataFrame, rows: str = "rows", seconds: str = "seconds") -> DataFrame:
    """Mean of the per-step rates and of the seconds per batch."""
    return trace.agg(
        F.avg(F.col(rows) / F.col(seconds)).alias("examples_per_sec"),
        F.avg(F.col(seconds)).alias("sec_per_batch"),
        F.count(F.lit(1)).alias("steps"),
    )
