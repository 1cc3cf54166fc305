"""Column expressions over numeric arrays; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_total(values: Column) -> Column:
    """Sum of an array of doubles."""
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def array_mean(values: Column) -> Column:
    """Mean of an array of doubles."""
    return array_total(values) / F.size(values)


def as_doubles(values: Column) -> Column:
    """Integer or float cells as doubles."""
    return F.transform(values, lambda v: v.cast("double"))


def one_hot(label: Column, classes: int) -> Column:
    """A vector with 1.0 at ``label`` and 0.0 elsewhere."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(classes - 1)), lambda k: (k == label).cast("double")
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _exp_shifted(logits: Column, top: Column) -> Column:
    return F.transform(logits, lambda z: F.exp(z - top))


def softmax(logits: Column) -> Column:
    """Class probabilities from logits."""

    def share(exps: Column) -> Column:
        return let(array_total(exps), lambda total: F.transform(exps, lambda e: e / total))

    return let(F.array_max(logits), lambda top: let(_exp_shifted(logits, top), share))


def log_sum_exp(logits: Column) -> Column:
    """``log(sum(exp z))``, finite for every finite input."""
    return let(
        F.array_max(logits), lambda top: top + F.log(array_total(_exp_shifted(logits, top)))
    )


def relu(values: Column) -> Column:
    """Negative cells set to 0."""
    return F.transform(values, lambda v: F.greatest(v, F.lit(0.0)))


def flatten(rows: Column) -> Column:
    """Nested rows (and channels) of an image as one vector."""
    return F.flatten(rows)


def reshape(values: Column, height: int, width: int) -> Column:
    """A vector as ``height`` rows of ``width`` cells."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(height - 1)),
        lambda r: F.slice(values, r * width + 1, F.lit(width)),
    )


def standardize(values: Column) -> Column:
    """``(x - mean) / max(stddev, 1/sqrt(n))`` per cell."""

    def spread(mean: Column) -> Column:
        squares = F.transform(values, lambda v: (v - mean) * (v - mean))
        return F.greatest(F.sqrt(array_mean(squares)), F.lit(1.0) / F.sqrt(F.size(values)))

    def scaled(mean: Column) -> Column:
        return let(spread(mean), lambda s: F.transform(values, lambda v: (v - mean) / s))

    return let(array_mean(values), scaled)


def crop_or_pad(rows: Column, height: int, width: int, zero: Column | None = None) -> Column:
    """Centre crop or zero-pad nested rows to ``height`` x ``width``."""
    zero = F.lit(0.0) if zero is None else zero

    def fit(cells: Column, size: int, blank: Column) -> Column:
        extra = F.size(cells) - size
        skip = F.when(extra > 0, F.floor(extra / 2)).otherwise(-F.floor(-extra / 2)).cast("int")
        inside = F.slice(cells, F.greatest(skip, F.lit(0)) + 1, F.lit(size))
        ahead = F.greatest(-skip, F.lit(0))
        behind = F.lit(size) - ahead - F.least(F.size(cells), F.lit(size))
        return F.concat(F.array_repeat(blank, ahead), inside, F.array_repeat(blank, behind))

    rows = F.transform(rows, lambda row: fit(row, width, zero))
    return let(rows, lambda cells: fit(cells, height, F.array_repeat(zero, width)))
