"""What plans must not contain, and results that must not depend on partitioning."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from ordinalis import storage
from ordinalis.catalog import views
from ordinalis.operators import agreement, encode, ensemble, language, regressors, thresholds
from ordinalis.plans import features

PLANNED = ("feature_table", "detect_language", "translate_reviews", "encode_text_pair", "kfold_assign", "holdout_split",
           "batch_assign", "oof_scatter", "qwk", "qwk_rounded", "vote_mode", "evaluate_run", "classification_report",
           "threshold_tail_sums", "threshold_candidates", "optimize_thresholds", "ensemble_test", "epoch_metrics",
           "staged_best_iter", "language_accuracy", "union_train_test")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_single_task_exchanges_carry_aggregates_only(spark, name):
    """One task may see counts and sums, or a bounded top list, but never rows of a table."""
    lines = [re.sub(r"^[\s:+*\-\d()]+", "", line) for line in
             plan_of(driver.queries()[name](spark, "/root/testdata/sf0.001")).splitlines()]
    assert not any("CartesianProduct" in line or "BroadcastNestedLoopJoin" in line for line in lines)
    for line, below in zip(lines, lines[1:]):
        if line.startswith("Exchange SinglePartition"):
            assert "Aggregate" in below.split("(")[0] or below.startswith("TakeOrdered"), below


def test_features_are_one_narrow_projection(spark):
    rows = spark.createDataFrame([], views.reviews(spark, "/root/testdata/sf0.001").schema)
    plan = plan_of(features.text_features(rows))
    assert "Exchange" not in plan and "Python" not in plan


def test_scan_reads_only_what_is_asked(spark):
    plan = plan_of(driver.queries()["kfold_assign"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_checking_and_voting_share_one_shuffle(spark):
    labels = ensemble.oof_scatter(spark.range(10).selectExpr("0 as trial", "id", "1 as label"))
    plan = plan_of(ensemble.vote_mode(labels, ["id"]))
    assert plan.count("Exchange hashpartitioning") == 1


def test_fold_filter_reads_one_folder(spark):
    table = storage.cut(spark.range(100).withColumn("fold", (F.col("id") % 5).cast("int")), "t", partition_by="fold")
    one = table.where("fold = 3")
    assert "PartitionFilters: [isnotnull(fold" in plan_of(one) and one.count() == 20
    assert all("fold=3" in r[0] for r in one.select(F.input_file_name()).distinct().collect())


def test_results_do_not_depend_on_partitioning(spark):
    sf = "/root/testdata/sf0.001"
    docs, preds, staged = views.table(spark, sf, "documents"), views.preds(spark, sf), views.staged(spark, sf)
    reviews = views.reviews(spark, sf).select("id", "review", "replyContent")

    def run(parts):
        d, p, r = docs.repartition(parts), preds.repartition(parts), reviews.repartition(parts)
        combined = ensemble.ensemble_weighted(p, {"boost_a": 0.6, "forest": 0.4})
        vocabulary = encode.build_vocabulary(r, ["review", "replyContent"], 50)
        results = (
            language.detect_language(d, "doc_id", "text", language.fit_language_profile(d)),
            encode.encode_text_pair(r, "id", "review", "replyContent", vocabulary, 64),
            thresholds.optimize_thresholds(combined, "y", "prediction", ["trial", "fold"]),
            agreement.qwk(p.withColumn("p", F.bround("forest").cast("int")), "y", "p", ["trial"]),
            regressors.staged_qwk(staged.repartition(parts), "y", F.col("increments")))
        return [sorted(map(str, df.collect())) for df in results]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    outcomes = []
    try:
        for parts in (1, 4, 200):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            outcomes.append(run(min(parts, 32)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert outcomes[0] == outcomes[1] == outcomes[2]


def test_run_tables_live_in_the_configured_folder_and_can_be_released(spark):
    path = storage.fresh_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(1).write.parquet(path)
    assert storage.path_complete(spark, path)
    storage._run_folder, real = (lambda s: path), storage._run_folder
    try:
        storage.release(spark)
    finally:
        storage._run_folder = real
    assert not storage.path_complete(spark, path)


def test_entry_returns_the_evaluation(spark):
    rows = driver.entry(spark).collect()
    assert {"accuracy", "qwk", "precision", "recall", "f1", "support"} == {r.metric for r in rows}
