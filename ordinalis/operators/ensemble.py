"""Combine predictions: weighted sums, cut at thresholds, majority vote, out-of-fold table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ordinalis.functions.ordinal import digitize, weighted_sum
from ordinalis.settings import START_THRESHOLDS

#: Rows that one task of ``oof_scatter`` holds in its hash tables.
ROWS_PER_TASK = 250_000


def ensemble_weighted(df: DataFrame, weights: dict[str, float], output: str = "prediction") -> DataFrame:
    """Wide predictions: one column per model, summed in place."""
    return df.withColumn(output, weighted_sum(weights))


def ensemble_long(df: DataFrame, weights: dict[str, float], by: list[str], model: str = "model",
                  value: str = "prediction") -> DataFrame:
    """Long predictions (by, model, value): the weights are literals, one partial-summed aggregate."""
    weight = F.create_map(*[F.lit(x) for item in weights.items() for x in item])
    return df.groupBy(*by).agg(F.sum(weight[F.col(model)] * F.col(value)).alias(value))


def cut_at(df: DataFrame, cuts: DataFrame, by: list[str], value: str = "prediction",
           output: str = "label", count: int = len(START_THRESHOLDS)) -> DataFrame:
    """Class labels from each group's own thresholds t1..tK (one row per group)."""
    names = [f"t{i + 1}" for i in range(count)]
    joined = df.join(cuts.select(*by, *names), by, "left")  # Spark sees the size when it has run the cuts
    return joined.withColumn(output, digitize(F.col(value), [F.col(n) for n in names])).drop(*names)


def vote_mode(df: DataFrame, by: list[str], label: str = "label", num_classes: int = 5,
              carry: list[str] | None = None) -> DataFrame:
    """(by, label): most frequent class, the smallest on ties.

    Class counters instead of collected labels: fixed-size buffers, summed map-side.
    ``carry`` columns are constant per group and are kept. A label that is no class raises.
    """
    value = F.col(label)
    strange = F.raise_error(F.concat(F.lit("label outside the classes: "), value.cast("string"))).cast("int")
    value = F.when(value.isNull() | value.between(0, num_classes - 1), value).otherwise(strange)
    counts = [F.count_if(value == k).alias(f"_c{k}") for k in range(num_classes)]
    kept = [F.first(c, ignorenulls=True).alias(c) for c in carry or []]
    votes = df.groupBy(*by).agg(*counts, *kept)
    tally = F.array(*[F.col(f"_c{k}") for k in range(num_classes)])
    winner = (F.array_position(tally, F.array_max(tally)) - 1).cast("int")
    return votes.select(*by, *(carry or []), F.when(F.array_max(tally) > 0, winner).alias(label))


def oof_scatter(parts: DataFrame, trial: str = "trial", id_col: str = "id") -> DataFrame:
    """Fold outputs as one out-of-fold table; two outputs for one (trial, id) raise.

    Rows are laid out by id alone, which serves this check and a later vote per id alike, in as
    many tasks as there are rows for: they are counted first, so what a task holds doesn't grow with them.
    """
    keep = [c for c in parts.columns if c not in (trial, id_col)]
    tasks = max(2, math.ceil(parts.count() / ROWS_PER_TASK))
    once = parts.repartition(tasks, id_col).groupBy(trial, id_col).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in keep])
    problem = F.raise_error(F.concat(F.lit("row predicted twice in one trial: "), F.col(id_col).cast("string")))
    # a filter, because an unused column would be pruned together with its check
    checked = once.where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(problem.cast("boolean")))
    return checked.select(trial, id_col, *keep)
