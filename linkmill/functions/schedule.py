"""Learning-rate schedules and per-variable settings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import DECAYED_GROUPS, DEFAULT_MOMENTUM, DEFAULT_RATE


def exp_decay(step: Column, start: float, target_factor: float, stairs: int, total_steps: Column) -> Column:
    """Staircase decay that ends at ``start / target_factor``.

    ``total_steps`` is counted in steps and split into ``stairs - 1`` equal
    stretches.
    """
    stretch = total_steps / F.lit(stairs - 1)
    rate = (1.0 / target_factor) ** (1.0 / (stairs - 1))
    return F.lit(float(start)) * F.pow(F.lit(rate), F.floor(step / stretch))


def exp_decay_at(step: int, start: float, target_factor: float, stairs: int, total_steps: float) -> float:
    """The same schedule for one step on the driver."""
    rate = (1.0 / target_factor) ** (1.0 / (stairs - 1))
    return start * rate ** (step // (total_steps / (stairs - 1)))


def pick_setting(name: Column, rules: list[tuple[str, float]], default: float) -> Column:
    """Setting of a variable: exact name, else first matching pattern, else default."""
    chosen = F.lit(float(default))
    for pattern, value in reversed(rules):
        chosen = F.when(name.rlike(pattern), F.lit(float(value))).otherwise(chosen)
    for exact, value in reversed(rules):
        chosen = F.when(name == F.lit(exact), F.lit(float(value))).otherwise(chosen)
    return chosen


def param_groups(
    df: DataFrame, var: str, step: Column, total_steps: Column, groups: tuple = DECAYED_GROUPS
) -> DataFrame:
    """Add ``learning_rate`` and ``momentum`` of each named variable at a step."""
    rate, momentum = F.lit(DEFAULT_RATE), F.lit(DEFAULT_MOMENTUM)
    name = F.col(var)
    ordered = [(lambda p: name.rlike(p), g) for g in reversed(groups)]
    ordered += [(lambda p: name == F.lit(p), g) for g in reversed(groups)]
    for matches, (pattern, start, target, stairs, mom) in ordered:
        decayed = exp_decay(step, start, target, stairs, total_steps)
        rate = F.when(matches(pattern), decayed).otherwise(rate)
        momentum = F.when(matches(pattern), F.lit(mom)).otherwise(momentum)
    return df.withColumns({"learning_rate": rate, "momentum": momentum})
