"""Boosted regression trees and forests grown on binned columns, for estimators of ``pyspark.ml``.

Spark's own fit runs one job per level of each tree over rows that are objects, which costs a small table
nothing but job starts and a large one a tenth of a microsecond per value. Here the rows are binned once
and lie in numpy blocks. A table of up to ``ALONE_CELLS`` values is fitted in one task, without
any job per round; a larger one keeps its blocks spread, a job per level adds up their sums per
(node, column, bin), and the driver sees only these sums.

The trees follow the rules of ``GBTRegressor``: splits half way between neighbouring values, or at
quantiles where a column has more values than bins; the largest drop of variance, the first on ties;
a share of the rows drawn anew each round; the first tree counts in full, each later one is fitted to twice
what is left over and counts by the step. The result is a ``GBTRegressionModel``. A forest
follows those of ``RandomForestRegressor``: each tree sees each row as often as a Poisson draw says, and all
columns; many trees grow at a time, a level of theirs in one job. Its result is a ``RandomForestRegressionModel``.
"""

from __future__ import annotations

import io
import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressionModel, GBTRegressionModel, GBTRegressor, RandomForestRegressionModel,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordinalis.storage import create, fresh_path

#: Rows times columns that one task fits alone: a few hundred MB at most by the sizes of its arrays. A job that runs Python takes
#: 0.1 s whatever it does, and a tree five of them, so below some two million rows of four columns one core is faster than all.
ALONE_CELLS = 8_000_000

#: Rows of a block, small enough for a core's cache.
BLOCK_ROWS = 1 << 16

#: Numbers in the sums of one level, beyond which Spark's own fit, which divides a level, is better.
MOST_SUMS = 1 << 22

#: Numbers that the driver adds up itself; if all tasks' sums are more, tasks add them up first.
COLLECTED_SUMS = 1 << 23

#: Numbers in the sums of a level of all trees of a forest that grow at a time.
FOREST_SUMS = 1 << 19

#: Trees deeper than this have too many nodes to number them all.
DEEPEST = 10

#: A variance below this is none; a drop below this share of the squares is rounding.
NO_VARIANCE, NO_DROP = np.finfo(float).eps, 1e-13


@dataclass(frozen=True)
class Rules:
    """What a ``GBTRegressor`` or ``RandomForestRegressor`` is asked for."""

    rounds: int
    step: float
    share: float
    depth: int
    bins: int
    least_rows: int
    least_gain: float
    seed: int
    checkpoint_every: int

    @staticmethod
    def of(estimator) -> Rules:
        forest = isinstance(estimator, RandomForestRegressor)
        return Rules(estimator.getNumTrees() if forest else estimator.getMaxIter(), 1.0 if forest else estimator.getStepSize(), estimator.getSubsamplingRate(), estimator.getMaxDepth(),
                     estimator.getMaxBins(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain(),
                     estimator.getSeed() & (2**64 - 1), estimator.getCheckpointInterval())

    def weight(self, round_: int) -> float:
        return self.step if round_ else 1.0


def columns_of(train: DataFrame, features: str) -> int | None:
    """How many features a row has; None without rows."""
    known = train.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    if known is not None:
        return known
    row = train.select(features).first()
    return None if row is None or row[0] is None else len(row[0])


def in_one_task(rows: int, width: int | None) -> bool:
    """Whether a table of that size is fitted by one task."""
    return width is not None and rows * width <= ALONE_CELLS


def _plain(estimator, train: DataFrame) -> bool:
    """True for the squared error of unweighted numeric columns, all of which a split may use; all else is left to Spark."""
    if type(estimator) is GBTRegressor:
        usual = estimator.getLossType() == "squared" and not estimator.isSet(estimator.validationIndicatorCol)
    else:
        usual = type(estimator) is RandomForestRegressor and estimator.getBootstrap()
    if not usual or estimator.getMaxDepth() > DEEPEST or estimator.isSet(estimator.weightCol):
        return False
    attributes = train.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (estimator.getFeatureSubsetStrategy() == "all" and estimator.getMinWeightFractionPerNode() == 0
            and not {"nominal", "binary"} & set(attributes))


def fit(estimator, train: DataFrame):
    """The fitted model of any estimator; boosted trees and forests are grown here, all else by Spark."""
    if not _plain(estimator, train):
        return estimator.fit(train)
    rules, width, rows = Rules.of(estimator), columns_of(train, estimator.getFeaturesCol()), train.count()
    if not rows or not width or width * rules.bins * 2 ** max(0, rules.depth - 1) > MOST_SUMS:
        return estimator.fit(train)
    table = train.select(vector_to_array(estimator.getFeaturesCol()).alias("x"),
                         F.col(estimator.getLabelCol()).cast("double").alias("y"))
    forest = isinstance(estimator, RandomForestRegressor)
    if in_one_task(rows, width):
        trees = _grown_alone(table, rules, forest_of if forest else boost)
    else:
        trees = (_forest_spread if forest else _grown_spread)(table, rules, rows)
    return _model(train.sparkSession, estimator, trees, width)


# --- columns and bins ------------------------------------------------------------------------

def _checked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(values by row and column, labels), refusing what Spark's own fit refuses."""
    x, y = batch.column("x"), batch.column("y")
    if x.null_count or y.null_count or np.isnan(y.to_numpy()).any():
        raise ValueError("features and labels of a fit must not be null or NaN")
    values = x.flatten().to_numpy().reshape(len(y), -1)
    if not np.isfinite(values).all():
        raise ValueError("features of a fit must not be NaN or infinite")
    return values, y.to_numpy()


def splits_of(values: np.ndarray, bins: int) -> np.ndarray:
    """The cuts of one column, as Spark places them; a value equal to a cut lies left of it."""
    found, counts = np.unique(values, return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    most = min(bins, len(values)) - 1
    if len(between) <= most:
        return between
    stride, kept = len(values) / (most + 1), []
    target, reached = stride, np.cumsum(counts).tolist()
    for i in range(1, len(reached)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            kept.append(i - 1)
            target += stride
    return between[kept]


def _binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bins by column and row."""
    kind = np.uint8 if max(map(len, cuts)) < 256 else np.uint16 if max(map(len, cuts)) < 65_536 else np.uint32
    return np.stack([np.searchsorted(cut, values[:, i]).astype(kind) for i, cut in enumerate(cuts)])


# --- one tree -----------------------------------------------------------------------------------

class Tree:
    """A tree being grown, level by level: the children of node i are 2i + 1 and 2i + 2."""

    def __init__(self, rules: Rules, cuts: list[np.ndarray]):
        size = 2 ** (rules.depth + 1) - 1
        self.feature, self.bin = np.full(size, -1), np.zeros(size, dtype=np.int64)
        self.stats, self.gain = np.zeros((size, 3)), np.full(size, -1.0)  # rows, sum and sum of squares
        self.open, self.level = np.zeros(1, dtype=np.int64), 0
        self._rules, self.widths = rules, [len(cut) + 1 for cut in cuts]

    @property
    def last(self) -> bool:
        """Whether the open nodes are the last that may be split."""
        return self.level >= self._rules.depth - 1

    @property
    def value(self) -> np.ndarray:
        n = self.stats[:, 0]
        return np.divide(self.stats[:, 1], n, out=np.zeros(len(n)), where=n > 0)

    def slots(self) -> np.ndarray:
        """For each node its place among the open ones; for all others the place behind them."""
        places = np.full(len(self.feature), len(self.open))
        places[self.open] = np.arange(len(self.open))
        return places

    def step(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The node of each row one level further down, where its node is split."""
        feature = self.feature[node]
        seen = bins.ravel()[np.maximum(feature, 0) * bins.shape[1] + np.arange(bins.shape[1])]
        return np.where(feature >= 0, 2 * node + 1 + (seen > self.bin[node]), node)

    def sums(self, bins: np.ndarray, target: np.ndarray, sampled: np.ndarray | None, node: np.ndarray,
             times: np.ndarray | None = None) -> np.ndarray:
        """(statistic, open node, bin of all columns side by side): rows, sum, and at the last level sum
        of squares. One more column holds the sum of squares of the node. ``sampled`` rows count, ``times`` each."""
        many = len(self.open)
        slot = self.slots()[node]
        if sampled is not None:
            slot = np.where(sampled, slot, many)
        weighted = target if times is None else times * target
        squares = weighted * target
        weights = [times, weighted, squares][:3 if self.last else 2]
        found = []
        for column, width in zip(bins, self.widths):
            code = slot * width + column
            found.append([np.bincount(code, w, minlength=(many + 1) * width).reshape(-1, width)[:many] for w in weights])
        beside = np.zeros((len(weights), many, 1))
        beside[0, :, 0] = np.bincount(slot, squares, minlength=many + 1)[:many]
        return np.concatenate([np.stack(part).astype(float) for part in found] + [beside], axis=2)

    def learn(self, sums: np.ndarray) -> None:
        """Splits the open nodes where that lowers the variance, and opens their children."""
        rules, many, nodes = self._rules, len(self.open), np.arange(len(self.open))
        n, s = sums[:2, :, :self.widths[0]].sum(axis=2)
        q = sums[0, :, -1]
        self.stats[self.open] = np.stack([n, s, q], axis=1)
        best, feature, place = np.full(many, -np.inf), np.full(many, -1), np.zeros(many, dtype=np.int64)
        starts = np.cumsum([0, *self.widths])
        for i, (start, width) in enumerate(zip(starts, self.widths)):
            if width < 2:
                continue
            sides = sums[:2, :, start:start + width].cumsum(axis=2)[:, :, :-1]
            n_left, s_left = sides
            n_right, s_right = n[:, None] - n_left, s[:, None] - s_left
            fits = (n_left >= max(1, rules.least_rows)) & (n_right >= max(1, rules.least_rows))
            with np.errstate(divide="ignore", invalid="ignore"):
                explained = np.where(fits, s_left * s_left / n_left + s_right * s_right / n_right, -np.inf)
            at = explained.argmax(axis=1)
            better = explained[nodes, at] > best
            best, feature, place = np.where(better, explained[nodes, at], best), np.where(better, i, feature), np.where(better, at, place)
        rows = np.maximum(n, 1)
        gain = (best - s * s / rows) / rows
        enough = (feature >= 0) & (gain > NO_DROP * q / rows) & (gain >= rules.least_gain) & (self.level < rules.depth)
        enough &= q / rows - (s / rows) ** 2 > NO_VARIANCE
        parents, left = self.open[enough], np.zeros((int(enough.sum()), 3))
        for side, k in zip(left, nodes[enough]):
            start = starts[feature[k]]
            side[:len(sums)] = sums[:, k, start:start + place[k] + 1].sum(axis=1)
        self.feature[parents], self.bin[parents], self.gain[parents] = feature[enough], place[enough], gain[enough]
        self.stats[2 * parents + 1], self.stats[2 * parents + 2] = left, self.stats[parents] - left
        was_last = self.last
        self.open = np.empty(0, dtype=np.int64) if was_last else np.concatenate([2 * parents + 1, 2 * parents + 2])
        self.level += 1


def _drawn(rules: Rules, round_: int, place: tuple[int, int], rows: int) -> np.ndarray | None:
    """Which rows of a block take part in a round: the same whenever it is asked."""
    if rules.share >= 1:
        return None
    return np.random.default_rng([rules.seed, round_, *place]).random(rows) < rules.share


def _times(rules: Rules, tree: int, place: tuple[int, int], rows: int) -> np.ndarray:
    """How often a tree of a forest sees each row of a block: Poisson draws, the same whenever they are asked."""
    chances, k = [np.exp(-rules.share)], 0
    while 1 - sum(chances) > 1e-12:
        k += 1
        chances.append(chances[-1] * rules.share / k)
    drawn = np.random.default_rng([rules.seed, tree, *place]).random(rows)
    return np.searchsorted(np.cumsum(chances), drawn, side="right")


def _seen(rules: Rules, tree: int, place: tuple[int, int], bins: np.ndarray, y: np.ndarray) -> tuple:
    """The rows of a block that a tree of a forest sees, and how often."""
    times = _times(rules, tree, place, len(y))
    rows = np.flatnonzero(times)
    return bins[:, rows], y[rows], times[rows].astype(float)


# --- in one task ---------------------------------------------------------------------------------

def boost(bins: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rules: Rules) -> Iterator[Tree]:
    """The trees of all rounds, one after the other, on rows that lie in memory."""
    starts = range(0, len(y), BLOCK_ROWS)
    blocks = [np.ascontiguousarray(bins[:, i:i + BLOCK_ROWS]) for i in starts]
    left = [y[i:i + BLOCK_ROWS].astype(float) for i in starts]
    for m in range(rules.rounds):
        targets = [2 * one for one in left] if m else left
        drawn = [_drawn(rules, m, (0, i), len(one)) for i, one in enumerate(left)]
        nodes = [np.zeros(len(one), dtype=np.int64) for one in left]
        tree = Tree(rules, cuts)
        while len(tree.open):
            tree.learn(sum(map(tree.sums, blocks, targets, drawn, nodes)))
            nodes = list(map(tree.step, blocks, nodes))
        value = rules.weight(m) * tree.value
        left = [one - value[node] for one, node in zip(left, nodes)]
        yield tree


def forest_of(bins: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rules: Rules) -> Iterator[Tree]:
    """The trees of a forest, one after the other, on rows that lie in memory."""
    starts = range(0, len(y), BLOCK_ROWS)
    for number in range(rules.rounds):
        blocks = [_seen(rules, number, (0, i), bins[:, a:a + BLOCK_ROWS], y[a:a + BLOCK_ROWS]) for i, a in enumerate(starts)]
        nodes = [np.zeros(len(target), dtype=np.int64) for _, target, _ in blocks]
        tree = Tree(rules, cuts)
        while len(tree.open):
            tree.learn(sum(tree.sums(b, target, None, node, times) for (b, target, times), node in zip(blocks, nodes)))
            nodes = [tree.step(block[0], node) for block, node in zip(blocks, nodes)]
        yield tree


def _grown_alone(table: DataFrame, rules: Rules, grow: Callable) -> list[list[dict]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [_checked(batch) for batch in filter(len, batches)]
        if not read:
            return
        values, y = np.concatenate([x for x, _ in read]), np.concatenate([y for _, y in read])
        read.clear()
        cuts = [splits_of(column, rules.bins) for column in values.T]
        bins = _binned(values, cuts)
        del values
        trees = [_nodes(tree, cuts) for tree in grow(bins, y, cuts, rules)]
        yield pa.RecordBatch.from_pydict({"trees": [json.dumps(trees)]})

    return json.loads(table.coalesce(1).mapInArrow(run, "trees string").collect()[0]["trees"])


# --- spread over all cores -------------------------------------------------------------------------

def _cuts(table: DataFrame, rules: Rules, rows: int) -> list[np.ndarray]:
    """Cuts from as many rows as Spark looks at for them: the square of the bins, or 10,000."""
    wanted = max(rules.bins ** 2, 10_000)
    drawn = table if rows <= wanted else table.sample(False, wanted / rows, rules.seed % 2**63)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [_checked(batch)[0] for batch in filter(len, batches)]
        found = [splits_of(column, rules.bins).tolist() for column in np.concatenate(read).T] if read else []
        yield pa.RecordBatch.from_pydict({"cuts": [json.dumps(found)]})

    return [np.array(cut, dtype=float) for cut in json.loads(drawn.repartition(1).mapInArrow(run, "cuts string").collect()[0]["cuts"])]


def _blocks(table: DataFrame, cuts: list[np.ndarray]):
    """An RDD of (place, bins, label): the blocks of one task per core."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    parts = table.rdd.getNumPartitions()
    table = table.repartition(cores) if parts < cores else table.coalesce(cores)  # every task costs its start again

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            bins, y = np.concatenate([b for b, _ in held], axis=1), np.concatenate([y for _, y in held])
            return pa.RecordBatch.from_pydict({"task": [task], "number": [number], "kind": [bins.dtype.str],
                                               "bins": [bins.tobytes()], "y": [y.tobytes()]})

        for batch in filter(len, batches):
            values, y = _checked(batch)
            held.append((_binned(values, cuts), y.copy()))
            rows += len(y)
            if rows >= BLOCK_ROWS:
                yield block()
                number, rows = number + 1, 0
                held.clear()
        if held:
            yield block()

    def read(row) -> tuple:
        y = np.frombuffer(row["y"])
        return (row["task"], row["number"]), np.frombuffer(row["bins"], row["kind"]).reshape(-1, len(y)), y

    return table.mapInArrow(run, "task long, number long, kind string, bins binary, y binary").rdd.map(read)


def _added(blocks, of_block: Callable, numbers: int) -> np.ndarray:
    """The sums of all blocks, so many ``numbers`` each."""
    def run(part: Iterable[tuple]) -> Iterator[np.ndarray]:
        total = None
        for block in part:
            one = of_block(*block)
            total = one if total is None else total + one
        if total is not None:
            yield total

    sums = blocks.mapPartitions(run)
    if blocks.getNumPartitions() * numbers > COLLECTED_SUMS:
        return sums.treeReduce(np.add)
    return reduce(np.add, sums.collect())


def _routed(tree: Tree, bins: np.ndarray) -> np.ndarray:
    node = np.zeros(bins.shape[1], dtype=np.int64)
    for _ in range(tree.level):
        node = tree.step(bins, node)
    return node


def _numbers(tree: Tree) -> int:
    """How many numbers the sums of a level have."""
    return (3 if tree.last else 2) * len(tree.open) * (sum(tree.widths) + 1)


def _summing(tree: Tree, rules: Rules, m: int) -> Callable:
    def of_block(place, bins, left):
        return tree.sums(bins, 2 * left if m else left, _drawn(rules, m, place, len(left)), _routed(tree, bins))
    return of_block


def _leaving(tree: Tree, weight: float) -> Callable:
    value = tree.value

    def of_block(block):
        place, bins, left = block
        return place, bins, left - weight * value[_routed(tree, bins)]
    return of_block


def _grown_spread(table: DataFrame, rules: Rules, rows: int) -> list[list[dict]]:
    """One job per level; what is left over is kept, in memory or on disk, beside the bins."""
    cuts = _cuts(table, rules, rows)
    blocks, older, trees = _blocks(table, cuts).persist(StorageLevel.MEMORY_AND_DISK), None, []
    try:
        for m in range(rules.rounds):
            tree = Tree(rules, cuts)
            while len(tree.open):
                tree.learn(_added(blocks, _summing(tree, rules, m), _numbers(tree)))
                if older is not None:  # the first job of the round has made what follows from it
                    older, _ = None, older.unpersist()
            trees.append(_nodes(tree, cuts))
            if m + 1 < rules.rounds:
                older, blocks = blocks, blocks.map(_leaving(tree, rules.weight(m))).persist(StorageLevel.MEMORY_AND_DISK)
                if rules.checkpoint_every > 0 and (m + 1) % rules.checkpoint_every == 0:
                    blocks.checkpoint()  # to the shared folder, so that a lost executor costs few rounds
    finally:
        for kept in filter(None, (older, blocks)):
            kept.unpersist()
    return trees


def _summing_all(trees: dict[int, Tree], rules: Rules) -> Callable:
    def of_block(place, bins, y):
        found = []
        for number, tree in trees.items():
            b, target, times = _seen(rules, number, place, bins, y)
            found.append(tree.sums(b, target, None, _routed(tree, b), times).ravel())
        return np.concatenate(found)
    return of_block


def _forest_spread(table: DataFrame, rules: Rules, rows: int) -> list[list[dict]]:
    """One job per level of many trees."""
    cuts = _cuts(table, rules, rows)
    blocks = _blocks(table, cuts).persist(StorageLevel.MEMORY_AND_DISK)
    most = 3 * 2 ** max(0, rules.depth - 1) * (sum(len(cut) + 1 for cut in cuts) + 1)
    at_a_time, trees = max(1, FOREST_SUMS // most), []
    try:
        for first in range(0, rules.rounds, at_a_time):
            group = {i: Tree(rules, cuts) for i in range(first, min(first + at_a_time, rules.rounds))}
            while growing := {i: tree for i, tree in group.items() if len(tree.open)}:
                ends = np.cumsum([_numbers(tree) for tree in growing.values()])
                sums = np.split(_added(blocks, _summing_all(growing, rules), int(ends[-1])), ends[:-1])
                for tree, part in zip(growing.values(), sums):
                    tree.learn(part.reshape(3 if tree.last else 2, len(tree.open), -1))
            trees += [_nodes(tree, cuts) for tree in group.values()]
    finally:
        blocks.unpersist()
    return trees


# --- the model -------------------------------------------------------------------------------------

def _nodes(tree: Tree, cuts: list[np.ndarray]) -> list[dict]:
    """The nodes of a tree, numbered as a saved model numbers them: each before its left, then its right part."""
    found, value = [], tree.value

    def add(i: int) -> int:
        n, s, q = tree.stats[i].tolist()
        node = {"id": len(found), "prediction": float(value[i]), "impurity": max(0.0, q / n - (s / n) ** 2) if n else 0.0,
                "impurityStats": [n, s, q], "rawCount": int(n), "gain": -1.0, "leftChild": -1, "rightChild": -1,
                "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        found.append(node)
        feature = int(tree.feature[i])
        if feature >= 0:
            node["gain"] = float(tree.gain[i])
            node["split"] = {"featureIndex": feature, "leftCategoriesOrThreshold": [float(cuts[feature][tree.bin[i]])], "numCategories": -1}
            node["leftChild"], node["rightChild"] = add(2 * i + 1), add(2 * i + 2)
        return node["id"]

    add(0)
    return found


class _OwnTrees:
    """Listing a model's parameters reads all its attributes but properties; its trees, a model each with parameters
    of its own, are only made where they are asked for."""

    @property
    def trees(self) -> list[DecisionTreeRegressionModel]:
        return [DecisionTreeRegressionModel(tree) for tree in self._call_java("trees")]


class Boosted(_OwnTrees, GBTRegressionModel):
    pass


class Forest(_OwnTrees, RandomForestRegressionModel):
    pass


_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                   ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT)])


def _described(spark: SparkSession, kind: str, uid: str, params: dict, defaults: dict, **more) -> str:
    return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000),
                       "sparkVersion": spark.version, "uid": uid, "paramMap": params, "defaultParamMap": defaults} | more)


def _model(spark: SparkSession, estimator, trees: list[list[dict]], width: int):
    """Written in the format of a saved model and loaded: Spark has no other public way to build one."""
    folder, rules = fresh_path(spark, "grown"), Rules.of(estimator)
    kind, wrapper = (("RandomForestRegressionModel", Forest) if isinstance(estimator, RandomForestRegressor) else
                     ("GBTRegressionModel", Boosted))
    named = lambda params: {p.name: value for p, value in params.items()}
    params, defaults = named(estimator._paramMap), named(estimator._defaultParamMap)
    own = {"maxDepth": rules.depth, "maxBins": rules.bins, "minInstancesPerNode": rules.least_rows, "minInfoGain": rules.least_gain}
    described = [_described(spark, "DecisionTreeRegressionModel", f"{estimator.uid}_{i}", own, {}) for i in range(len(trees))]
    nodes = pa.table({"treeID": pa.array([i for i, tree in enumerate(trees) for _ in tree], pa.int32()),
                      "nodeData": pa.array([node for tree in trees for node in tree], _NODE)})
    weights = pa.table({"_1": pa.array(range(len(trees)), pa.int32()), "_2": described,
                        "_3": [rules.weight(i) for i in range(len(trees))]})
    for name, table in (("data", nodes), ("treesMetadata", weights)):
        file = io.BytesIO()
        pq.write_table(table, file)
        create(spark, f"{folder}/{name}/part-00000.parquet", file.getvalue())
    text = _described(spark, kind, estimator.uid, params, defaults, numFeatures=width, numTrees=len(trees))
    create(spark, f"{folder}/metadata/part-00000", text.encode())
    loaded = getattr(spark._jvm.org.apache.spark.ml.regression, kind).load(folder)
    return estimator._copyValues(wrapper(loaded))  # as its own fit hands over a model
