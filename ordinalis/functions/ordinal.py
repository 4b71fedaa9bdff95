"""Expressions that turn a continuous score into an ordinal class."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def digitize(value: Column, thresholds: list[Column | float]) -> Column:
    """Number of thresholds at or below the value: left-closed bins, NaN goes on top."""
    cuts = [t if isinstance(t, Column) else F.lit(float(t)) for t in thresholds]
    return reduce(add, [(value >= t).cast("int") for t in cuts])


def round_half_even(value: Column) -> Column:
    return F.bround(value).cast("int")


def weighted_sum(columns: dict[str, float]) -> Column:
    """Sum of weight times column, in the given order."""
    return reduce(add, [F.lit(float(w)) * F.col(name) for name, w in columns.items()])
