"""The four tree regressors, their early stopping, and scoring with the kept rounds.

Spark's boosted trees have no L1/L2 leaf penalties and no bagging interval, so those settings
of common boosting libraries have no twin here. ``build`` may return any ``pyspark.ml``
regressor instead; staged stopping applies to GBTRegressor models only.

Boosting that may stop early runs in blocks of rounds: each block is fitted to what the
blocks before it leave over, its rounds are judged on the validation rows, and no further
block is fitted once patience has run out. A block is as long as patience is sure to look: the
first has one round more than patience, each later one ends where patience would, counted from the
best round so far. So no round is fitted in vain, and blocks are few whatever the curve does. The
first tree of a block counts in full, as the first tree of any such model does.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordinalis.operators import boosting
from ordinalis.operators.agreement import qwk
from ordinalis.settings import Settings
from ordinalis.storage import cut, shared_dir

#: Rounds of a fit after which its residuals are written to the shared folder.
CHECKPOINT_EVERY = 25

#: Rows one task of a fit handles. A round is a handful of jobs, one per level of its tree, so a
#: small table fits fastest in one task; a large one keeps its partitions.
ROWS_PER_TASK = 20_000

#: Tasks per core of a fit on a large table that lies in fewer. Each task sends the sums of all nodes of a
#: level, so many more would be more to shuffle.
TASKS_PER_CORE = 2

#: Rows from which a forest's passes cost more than the jobs they take.
MANY_ROWS = 250_000


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has ``rows`` rows, in no more tasks than they are worth."""
    return df.coalesce(_worth(rows))


def _worth(rows: int) -> int:
    return max(1, math.ceil(rows / ROWS_PER_TASK))


def fit_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks that keep a fit on ``rows`` rows and all cores busy."""
    return min(_worth(rows), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def for_fit(df: DataFrame, rows: int) -> DataFrame:
    """``few_tasks``, but a table that lies in a few large files is dealt out to all cores."""
    wanted = fit_tasks(df.sparkSession, rows)
    if wanted > 1 and df.rdd.getNumPartitions() < wanted:
        return df.repartition(wanted)
    return few_tasks(df, rows)


def impute_days(df: DataFrame) -> DataFrame:
    """Trees reject nulls: -1 for a missing ``days_to_reply`` and an indicator beside it."""
    return impute(df, {"days_to_reply": "days_missing"})


def impute(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """-1 for each missing value, and for each column (key) an indicator (value) beside it."""
    filled = {c: F.coalesce(F.col(f"`{c}`"), F.lit(-1).cast(df.schema[c].dataType)) for c in columns}
    return df.withColumns({flag: F.col(f"`{c}`").isNull().cast("int") for c, flag in columns.items()} | filled)


def assemble(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """One feature vector per row."""
    plain = df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(columns)])
    vectors = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(columns))], outputCol="features")
    return vectors.transform(plain).select(*keep, "features")


@dataclass(frozen=True)
class Learner:
    """How to build one regressor, and which metric stops it early (None: it never stops)."""

    name: str
    build: Callable[[int, Settings], object]
    stop_on: str | None = None


def _boosted(step: float, bins: int, share: float):
    def build(seed: int, settings: Settings) -> GBTRegressor:
        return GBTRegressor(featuresCol="features", labelCol="score", maxDepth=5, stepSize=step, maxBins=bins,
                            subsamplingRate=share, maxIter=settings.boost_rounds, seed=seed,
                            checkpointInterval=CHECKPOINT_EVERY)
    return build


def _forest(seed: int, settings: Settings) -> RandomForestRegressor:
    # splitting needs 5 rows; two per leaf is the nearest setting Spark has
    return RandomForestRegressor(featuresCol="features", labelCol="score", numTrees=settings.forest_trees,
                                 maxDepth=settings.forest_depth, minInstancesPerNode=2,
                                 featureSubsetStrategy="all", seed=seed)


LEARNERS = (
    Learner("boost_a", _boosted(step=0.07, bins=512, share=0.8), stop_on="qwk"),
    Learner("boost_b", _boosted(step=0.1, bins=256, share=1.0), stop_on="rmse"),
    Learner("boost_c", _boosted(step=0.1, bins=256, share=0.8), stop_on="qwk"),
    Learner("forest", _forest),
)


@dataclass(frozen=True)
class Fitted:
    """A fitted regressor, in blocks for boosting, and how many rounds count (None: all)."""

    name: str
    blocks: tuple
    rounds: int | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Adds the prediction under the learner's name."""
        left, total, kept = self.rounds, F.lit(0.0), [*df.columns]
        for i, model in enumerate(self.blocks):
            if left is not None and left <= 0:
                break
            if left is None or left >= len(model.treeWeights):
                df = model.copy({model.predictionCol: f"_block{i}"}).transform(df)
            else:
                steps = F.slice(round_contributions(model), 1, left)
                df = (_with_leaves(model, df).withColumn(f"_block{i}", F.aggregate(steps, F.lit(0.0), lambda a, b: a + b))
                      .drop("_leaf", "_prediction"))
            total = total + F.col(f"_block{i}")
            left = None if left is None else left - len(model.treeWeights)
        return df.withColumn(self.name, total).select(*[c for c in kept if c != self.name], self.name)


def _with_leaves(model, df: DataFrame) -> DataFrame:
    return model.copy({model.leafCol: "_leaf", model.predictionCol: "_prediction"}).transform(df)


def round_contributions(model) -> Column:
    """What each boosting round adds to a row's prediction, looked up from its leaf numbers.

    Leaves are numbered left to right, the order in which a tree prints its predictions.
    """
    leaves = [[float(v) * weight for v in re.findall(r"Predict: (\S+)", tree.toDebugString())]
              for tree, weight in zip(model._call_java("trees"), model.treeWeights)]
    # one folded literal; an expression per leaf would make a plan of thousands of nodes
    values = F.from_json(F.lit(json.dumps(leaves)), "array<array<double>>")
    return F.zip_with(values, vector_to_array(F.col("_leaf")), lambda v, leaf: F.get(v, leaf.cast("int")))


def _staged(df: DataFrame, y: str, steps: Column, summary: Callable, schema: str) -> DataFrame:
    """Per Arrow batch: running sums over the rounds, summarised before anything is shuffled.

    A running sum over an array has no built-in; exploding rounds into rows for a window would
    multiply the data by the number of rounds.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            if len(batch):
                yield summary(batch["y"].to_numpy(), np.stack(batch["steps"]).cumsum(axis=1))

    return df.select(F.col(y).cast("int").alias("y"), steps.alias("steps")).mapInPandas(run, schema)


def staged_counts(df: DataFrame, y: str, steps: Column) -> DataFrame:
    """(iter, y, p, n): how often a label meets a rounded prediction after each round.

    A batch leaves its counts of (iter, y, p): a few numbers per round instead of every row.
    """
    def summary(labels, sums):
        import numpy as np

        rounded = np.rint(sums).astype("int64")
        low, span = rounded.min(), int(np.ptp(rounded)) + 1
        lowest, width = labels.min(), int(np.ptp(labels)) + 1
        place = np.arange(sums.shape[1]) * width + (labels - lowest).astype("int64")[:, None]
        code = (place * span + (rounded - low)).ravel()
        if sums.shape[1] * width * span <= 4 * code.size:
            counts = np.bincount(code)
            found = counts.nonzero()[0]
            counts = counts[found]
        else:  # predictions far apart: too many empty cells to count densely
            found, counts = np.unique(code, return_counts=True)
        return pd.DataFrame({"iter": found // span // width + 1, "y": found // span % width + lowest,
                             "p": found % span + low, "n": counts})

    return _staged(df, y, steps, summary, "iter int, y int, p long, n long")


def staged_qwk(df: DataFrame, y: str, steps: Column) -> DataFrame:
    """(iter, qwk): kappa of the rounded prediction after each round."""
    return qwk(staged_counts(df, y, steps), "y", "p", by=["iter"], count="n")


def best_iteration(scores: DataFrame, patience: int, value: str = "qwk", digits: int = 9) -> DataFrame:
    """(best_iter, best): first strict maximum before ``patience`` rounds without a better one.

    ``scores`` has one row per boosting round: a curve short enough for one array, read in order.
    """
    score = F.coalesce(F.round(value, digits), F.lit(float("-inf")))
    curve = scores.agg(F.array_sort(F.collect_list(F.struct("iter", score.alias("q")))).alias("curve"))

    def state(best: Column, at: Column, stopped: Column) -> Column:
        return F.struct(best.alias("best"), at.cast("int").alias("at"), stopped.alias("stopped"))

    def step(seen: Column, now: Column) -> Column:
        better = (seen["at"] == 0) | (now["q"] > seen["best"])
        waited = now["iter"] - seen["at"] >= patience
        return (F.when(seen["stopped"], seen).when(better, state(now["q"], now["iter"], F.lit(False)))
                .otherwise(state(seen["best"], seen["at"], waited)))

    start = state(F.lit(float("-inf")), F.lit(0), F.lit(False))
    found = curve.select(F.aggregate("curve", start, step).alias("_b"))
    return found.select(F.col("_b.at").alias("best_iter"), F.col("_b.best").alias("best"))


def fit_learner(learner: Learner, train: DataFrame, seed: int, settings: Settings,
                validation: DataFrame | None = None, rounds: int | None = None) -> Fitted:
    """Fit on (features, score). With validation rows, boosting stops when patience runs out and
    keeps the best rounds; without them it runs ``rounds``, or all rounds of the settings."""
    shared_dir(train.sparkSession)  # boosting checkpoints go to the shared folder
    if learner.stop_on is None:
        return Fitted(learner.name, (boosting.fit(_few_nodes(learner.build(seed, settings), train), train),))
    if validation is None:
        settings = replace(settings, boost_rounds=rounds or settings.boost_rounds)
        return Fitted(learner.name, (boosting.fit(learner.build(seed, settings), train),), settings.boost_rounds)
    return _fit_until_patience(learner, train, seed, settings, validation)


def _few_nodes(estimator, train: DataFrame):
    """A forest on many rows takes few nodes a pass instead of a whole level, so that their sums stay in a
    core's cache: more passes, far shorter ones, and the same trees, as every node sees all columns."""
    if (isinstance(estimator, RandomForestRegressor) and not estimator.isSet("maxMemoryInMB")
            and estimator.getFeatureSubsetStrategy() == "all" and train.count() >= MANY_ROWS):
        return estimator.copy({estimator.maxMemoryInMB: 1})
    return estimator


def _fit_until_patience(learner: Learner, train: DataFrame, seed: int, settings: Settings,
                        validation: DataFrame) -> Fitted:
    """``score`` of both tables becomes what is left over; ``_y`` and ``_base`` keep label and sum."""
    train = train.select("features", F.col("score").cast("double").alias("score"))
    held = validation.select("features", F.col("score").cast("double").alias("score"), F.col("score").alias("_y"),
                             F.lit(0.0).alias("_base"))
    blocks, curve, best = [], [], 0
    while True:
        done = len(curve)
        # every round that the rule will look at whatever comes, and none that it would not
        size = min(settings.boost_rounds, max(best, 1) + settings.patience) - done
        size = min(size, settings.round_block or size)
        model = boosting.fit(learner.build(seed + done, replace(settings, boost_rounds=size)), train)
        blocks.append(model)
        curve += _block_curve(learner, model, held)
        best = _best_round(curve, settings.patience)
        if len(curve) - best >= settings.patience or len(curve) >= settings.boost_rounds:
            return Fitted(learner.name, tuple(blocks), best)
        # written, both parts by one job, so that a block neither predicts with all blocks before it
        # nor depends on them
        left, moved = F.col("score") - F.col("prediction"), F.col("_base") + F.col("prediction")
        both = (model.transform(train).select("features", left.alias("score"), F.lit(False).alias("held"))
                .unionByName(model.transform(held).select("features", left.alias("score"), "_y", moved.alias("_base"),
                                                          F.lit(True).alias("held")), allowMissingColumns=True))
        both = cut(both, "left-over", partition_by="held")
        train = both.where(~F.col("held")).select("features", "score")
        held = both.where("held").select("features", "score", "_y", "_base")


def _best_round(curve: list[float | None], patience: int, digits: int = 9) -> int:
    """The rule of ``best_iteration`` for a curve that is on the driver already."""
    best, at = -math.inf, 0
    for i, value in enumerate(curve, 1):
        value = -math.inf if value is None else round(value, digits)
        if at == 0 or value > best:
            best, at = value, i
        elif i - at >= patience:
            break
    return at


def _block_curve(learner: Learner, model, held: DataFrame) -> list[float | None]:
    """The score on the validation rows after each round of the block, larger is better."""
    if learner.stop_on == "rmse":
        return [-math.sqrt(error) for error in model.evaluateEachIteration(held, "squared")]
    steps = F.transform(round_contributions(model), lambda step, i: step + F.when(i == 0, F.col("_base")).otherwise(0.0))
    counts = staged_counts(_with_leaves(model, held), "_y", steps)
    return _kappas(counts.groupBy("iter", "y", "p").agg(F.sum("n").alias("n")).collect(), len(model.treeWeights))


def _kappas(counts: list, rounds: int) -> list[float | None]:
    """``agreement.qwk`` of each round, from its pairs of a label and a prediction: so few after a
    block's rounds that another job would only cost time."""
    import numpy as np

    of_round: dict[int, list] = {}
    for i, *pair in counts:
        of_round.setdefault(i, []).append(pair)
    found = []
    for i in range(1, rounds + 1):
        y, p, n = np.array(of_round[i]).T
        place = np.unique(np.concatenate([y, p]), return_inverse=True)[1].astype(float)
        a, b, n, total = place[:len(y)], place[len(y):], n.astype(float), float(n.sum())
        bottom = total * ((n * a * a).sum() + (n * b * b).sum()) - 2 * (n * a).sum() * (n * b).sum()
        found.append(float(1 - total * (n * (a - b) ** 2).sum() / bottom) if bottom else None)
    return found


def predict_long(df: DataFrame, fitted: list[Fitted], keep: list[str]) -> DataFrame:
    """(keep..., model, prediction) from every fitted model in one pass over the rows."""
    for one in fitted:
        df = one.score(df)
    pairs = [F.struct(F.lit(f.name).alias("model"), F.col(f.name).alias("prediction")) for f in fitted]
    return df.select(*keep, F.inline(F.array(*pairs)))
