"""Boosted trees grown on binned blocks, against Spark's own fit of the same estimator."""

import re

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from ordinalis.operators import boosting, regressors
from ordinalis.plans import training
from ordinalis.settings import Settings
from ordinalis.storage import cut
from tests.small import small_settings


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    a, b, c = rng.normal(size=900).round(2), rng.integers(0, 6, 900), rng.integers(0, 40, 900)
    y = np.clip(np.rint(a + b / 2 + c / 20 + rng.normal(size=900) / 3), 0, 4)
    made = spark.createDataFrame([(i, int(y[i]), float(a[i]), float(b[i]), 7.0, float(c[i])) for i in range(900)],
                                 "id int, score int, a double, b double, same double, c double")
    return cut(regressors.assemble(made, ["a", "b", "same", "c"], ["id", "score"]).repartition(5), "boosted-rows")


def shape_and_values(model):
    lines = model.toDebugString.split("\n")[1:]
    return [re.sub(r"-?\d+\.\d+(E-?\d+)?", "", line) for line in lines], [float(v) for line in lines for v in re.findall(r"-?\d+\.\d+(?:E-?\d+)?", line)]


@pytest.mark.parametrize("cells", [10**9, 1], ids=["in one task", "spread"])
@pytest.mark.parametrize("bins, least, depth", [(256, 1, 5), (24, 4, 3)])
def test_trees_are_those_of_spark(rows, monkeypatch, cells, bins, least, depth):
    monkeypatch.setattr(boosting, "ALONE_CELLS", cells)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    estimator = GBTRegressor(labelCol="score", maxIter=4, maxDepth=depth, maxBins=bins, minInstancesPerNode=least, stepSize=0.07, seed=5)
    theirs, ours = estimator.fit(rows), boosting.fit(estimator, rows)
    (shape, values), (own_shape, own_values) = shape_and_values(theirs), shape_and_values(ours)
    assert shape == own_shape and len(shape) > 20
    assert own_values == pytest.approx(values, abs=1e-9)
    assert ours.treeWeights == theirs.treeWeights and ours.getMaxIter() == 4 and ours.numFeatures == 4
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)


@pytest.mark.parametrize("cells", [10**9, 1], ids=["in one task", "spread"])
def test_a_share_of_the_rows_is_drawn_alike_by_each_run(rows, monkeypatch, cells):
    monkeypatch.setattr(boosting, "ALONE_CELLS", cells)
    fits = [boosting.fit(GBTRegressor(labelCol="score", maxIter=3, subsamplingRate=0.5, seed=seed), rows).toDebugString.split("\n", 1)[1]
            for seed in (5, 5, 6)]
    assert fits[0] == fits[1] != fits[2]


def test_a_small_fit_takes_few_jobs_whatever_its_rounds(spark, rows):
    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"fit of {rounds}", "")
        model = regressors.fit_learner(regressors.LEARNERS[0], rows, 42, small_settings(boost_rounds=rounds)).blocks[0]
        assert len(model.treeWeights) == rounds
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit of {rounds}"))

    assert jobs(2) == jobs(30) <= 12


def test_a_lone_label_and_few_rows_are_one_leaf(spark, rows):
    one = rows.where("id < 40").withColumn("score", F.lit(3))
    model = boosting.fit(GBTRegressor(labelCol="score", maxIter=3), one)
    assert model.totalNumNodes == 3 and [r.prediction for r in model.transform(one).select("prediction").distinct().collect()] == [3.0]


def test_other_estimators_and_losses_are_left_to_spark(rows):
    absolute = GBTRegressor(labelCol="score", maxIter=2, lossType="absolute")
    assert boosting.fit(absolute, rows).toDebugString.split("\n", 1)[1] == absolute.fit(rows).toDebugString.split("\n", 1)[1]
    assert type(boosting.fit(LinearRegression(labelCol="score"), rows)).__name__ == "LinearRegressionModel"


@pytest.mark.parametrize("label", ["null", "double('NaN')"])
def test_missing_labels_are_refused(rows, label):
    with pytest.raises(Exception, match="(?i)null or NaN"):
        boosting.fit(GBTRegressor(labelCol="score", maxIter=1), rows.withColumn("score", F.expr(f"if(id = 7, {label}, double(score))")))


@pytest.mark.parametrize("cells", [10**9, 1], ids=["in one task", "spread"])
def test_a_forest_is_as_good_as_sparks_and_the_same_each_time(rows, monkeypatch, cells):
    monkeypatch.setattr(boosting, "ALONE_CELLS", cells)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    monkeypatch.setattr(boosting, "FOREST_SUMS", 3 * 16 * 100 * 7)  # several groups of trees
    estimator = RandomForestRegressor(labelCol="score", numTrees=30, maxDepth=5, minInstancesPerNode=2, featureSubsetStrategy="all", seed=5)
    theirs, ours, again = estimator.fit(rows), boosting.fit(estimator, rows), boosting.fit(estimator, rows)
    error = lambda model: model.transform(rows).agg(F.avg(F.pow(F.col("prediction") - F.col("score"), 2))).first()[0]
    assert error(ours) == pytest.approx(error(theirs), rel=0.05)
    assert ours.toDebugString.split("\n", 1)[1] == again.toDebugString.split("\n", 1)[1]
    assert len(ours.trees) == ours.getNumTrees == 30 and len({tree.toDebugString.split("\n", 1)[1] for tree in ours.trees}) == 30
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.03)


def test_one_tree_of_a_forest_is_sparks_on_the_rows_it_drew(rows, monkeypatch):
    """The rows as often as the first tree saw them, given to Spark's lone tree."""
    ours = boosting.fit(RandomForestRegressor(labelCol="score", numTrees=1, maxDepth=4, maxBins=999, minInstancesPerNode=2,
                                              featureSubsetStrategy="all", seed=5), rows.coalesce(1))
    rules = boosting.Rules(1, 1.0, 1.0, 4, 999, 2, 0.0, 5, 10)
    times = boosting._times(rules, 0, (0, 0), 900)
    assert 0.9 < times.mean() < 1.1 and 0.8 < times.var() < 1.2
    here = rows.coalesce(1).collect()
    drawn = rows.sparkSession.createDataFrame([row for row, n in zip(here, times) for _ in range(n)], rows.schema)
    theirs = DecisionTreeRegressor(labelCol="score", maxDepth=4, maxBins=999, minInstancesPerNode=2).fit(drawn)
    predicted = lambda model: np.array([r.prediction for r in model.transform(drawn).orderBy("id").collect()])
    assert ((predicted(theirs) - predicted(ours)) ** 2).mean() < 0.02


def test_a_small_forest_takes_few_jobs(spark, rows):
    spark.sparkContext.setJobGroup("a forest", "")
    regressors.fit_learner(regressors.LEARNERS[3], rows, 42, Settings())
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("a forest")) <= 12


def test_fits_in_one_task_overlap_on_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert training._at_a_time(spark, Settings(), 100_000, 4) == 2 * cores
    assert training._at_a_time(spark, Settings(), 10**9, 4) == 4
