"""Classifier, components, regressors, early stopping and the composite jobs."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ordinalis.catalog import views
from ordinalis.operators import encode, regressors, sentiment, thresholds
from ordinalis.plans import features, review_run as whole, training
from ordinalis.settings import MODEL_WEIGHTS, Settings
from ordinalis.storage import cut
from tests.small import small_settings
from tests.test_agreement import brute_kappa

SMALL = small_settings()


@pytest.fixture(scope="module")
def reviews(spark):
    return cut(views.reviews(spark, "/root/testdata/sf0.001"), "reviews").persist()


@pytest.fixture(scope="module")
def matrix(spark):
    rows = views.order_features(spark, "/root/testdata/sf0.001")
    return cut(regressors.assemble(rows, ["sum_qty", "avg_disc", "max_tax", "n_lines"], ["id", "score"]), "m").persist()


def test_scores_are_distributions(reviews):
    model = sentiment.fit_sentiment_model(reviews.where("split = 'train'"), "review", "replyContent", SMALL)
    rows = sentiment.score_sentiment(reviews, model, "review", "replyContent").collect()
    assert len(rows) == reviews.count()
    assert all(len(r.probs) == 5 and abs(sum(r.probs) - 1) < 1e-9 for r in rows)
    losses = sentiment.loss_history(model)
    assert losses[-1] < losses[0]
    table = features.feature_table(reviews, model, SMALL).collect()
    assert all(sum(r[f"sentiment_{k}"] for k in range(5)) == 1 for r in table)
    assert all(r[f"sentiment_{int(np.argmax(r.probs))}"] == 1 for r in table)


def test_plugged_in_scorer_sees_each_pair_once(spark):
    rows = spark.createDataFrame([(i, "a" if i % 2 else None, "r") for i in range(40)],
                                 "id int, review string, replyContent string")

    def make_predict():
        import numpy as np

        def predict(reviews, replies):
            return np.array([[len(a), len(b), 0.0] for a, b in zip(reviews, replies)])
        return predict

    got = sentiment.score_with(rows, "review", "replyContent", make_predict).collect()
    assert len(got) == 40 and all(r.probs == [1.0 if r.id % 2 else 0.0, 1.0, 0.0] for r in got)


def test_cross_fit_scores_every_row_once(reviews):
    settings = small_settings(cross_fit=True)
    table = whole.review_features(reviews, settings, "review")
    assert table.count() == reviews.count() == table.select("id").distinct().count()
    assert table.where(F.col("probs").isNull() | F.col("pca_1").isNull()).count() == 0


def test_components_match_svd(spark):
    rng = np.random.default_rng(0)
    x = rng.dirichlet(np.ones(5), 200)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"{k}_prob" for k in range(5)])
    got = np.array([[r.pca_1, r.pca_2] for r in sentiment.fit_pca(df, df.columns, 2).apply(df).collect()])
    axes = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:2]
    signs = np.array([np.sign(a[np.abs(a).argmax()]) for a in axes])
    expected = (x - x.mean(0)) @ (axes * signs[:, None]).T
    order = lambda m: m[np.lexsort(m.T)]
    assert np.allclose(order(got), order(expected), atol=1e-9)


def test_contributions_add_up_to_the_prediction(matrix):
    settings = small_settings(boost_rounds=6)
    fitted = regressors.fit_learner(regressors.LEARNERS[0], matrix, 42, settings)
    model = fitted.blocks[0]
    steps = regressors.round_contributions(model)
    scored = regressors._with_leaves(model, matrix)
    total = F.aggregate(steps, F.lit(0.0), lambda a, b: a + b)
    assert scored.where(F.abs(total - F.col("_prediction")) > 1e-9).count() == 0
    part = regressors.Fitted("x", (model,), 2).score(matrix)
    two = F.aggregate(F.slice(steps, 1, 2), F.lit(0.0), lambda a, b: a + b)
    both = part.select("id", "x").join(scored.select("id", two.alias("two")), "id")
    assert both.where(F.abs(F.col("x") - F.col("two")) > 1e-12).count() == 0


@pytest.mark.parametrize("curve, patience, expected", [
    ([0.1, 0.5, 0.5, 0.4], 100, 2),  # a tie is no improvement
    ([0.1, 0.5, 0.4, 0.3, 0.9], 2, 2),  # stopped before the later peak
    ([0.1, 0.5, 0.4, 0.9], 2 + 1, 4),
    ([0.9, 0.1, 0.1], 1, 1),
    ([None, None, 0.2], 5, 3)])
def test_patience(spark, curve, patience, expected):
    scores = spark.createDataFrame([(i + 1, q) for i, q in enumerate(curve)], "iter int, qwk double")
    assert regressors.best_iteration(scores, patience).first().best_iter == expected


def test_days_are_imputed(spark):
    rows = spark.createDataFrame([(1, None), (2, 4)], "id int, days_to_reply long")
    assert [tuple(r) for r in regressors.impute_days(rows).orderBy("id").collect()] == [(1, -1, 1), (2, 4, 0)]


def test_cross_validation_learns(matrix):
    got = training.kfold_oof(matrix, SMALL)
    rows = got.labels.collect()
    assert len({r.id for r in rows}) == len(rows) == matrix.count()
    assert {r.label for r in rows} <= set(range(5))
    assert np.mean([r.label == r.score for r in rows]) > 0.9
    assert got.cuts.where("qwk < 0.9").count() == 0
    mean = thresholds.mean_thresholds(got.cuts, ["trial"]).first()
    assert [mean.t1, mean.t2, mean.t3, mean.t4] == sorted([mean.t1, mean.t2, mean.t3, mean.t4])


def test_whole_run(spark, reviews):
    result = whole.review_run(reviews, small_settings(translate=False))
    test_ids = {r.id for r in reviews.where("split = 'test'").collect()}
    assert {r.id for r in result.submission.collect()} == test_ids
    values = {(r.metric, r["class"]): r.value for r in result.run.evaluation.collect()}
    assert values["support", "macro avg"] == reviews.where("split = 'train'").count()
    assert 0 <= values["accuracy", "all"] <= 1 and "probs" not in result.features.columns
    assert result.run.validated.labels.count() == 2 * values["support", "macro avg"]


def test_full_size_settings():
    full = Settings()
    assert full.trial_seeds() == [42 * i for i in range(1, 11)]
    assert full.num_trials * full.num_folds * 4 + full.num_trials * 4 == 440
    assert sum(MODEL_WEIGHTS.values()) == pytest.approx(1.0)
    assert len(features.model_matrix_columns(full)) == 17 + 2


def test_staged_curves_match_brute_force(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 5, 300)
    steps = np.concatenate([np.full((300, 1), 2.0), rng.integers(-200, 200, (300, 6)) / 256 + (y[:, None] - 2) / 8], axis=1)
    steps[0, 1] = 1e6  # one wild prediction must not hurt
    df = spark.createDataFrame([(int(a), [float(v) for v in s]) for a, s in zip(y, steps)], "y int, s array<double>")
    sums = steps.cumsum(axis=1)
    kappas = {r.iter: r.qwk for r in regressors.staged_qwk(df, "y", F.col("s")).collect()}
    for i in range(7):
        p = np.rint(sums[:, i]).astype(int).tolist()
        labels = sorted(set(p) | set(y.tolist()))
        assert kappas[i + 1] == pytest.approx(brute_kappa(y.tolist(), p, labels), abs=1e-12)


def test_training_with_holdout_reports_both_parts(reviews):
    train = reviews.where("split = 'train'")
    done = sentiment.train_sentiment(train, "id", "review", "replyContent", small_settings(all_train=False))
    for table in (done.train_metrics, done.validation_metrics):
        rows = sorted(table.collect(), key=lambda r: r.epoch)
        assert [r.epoch for r in rows] == [1, 2, 3] and all(0 <= r.accuracy <= 1 and r.loss > 0 for r in rows)
    losses = [r.loss for r in sorted(done.train_metrics.collect(), key=lambda r: r.epoch)]
    assert losses[2] < losses[0]  # the smoothed loss is what the fit minimises
    assert sentiment.train_sentiment(train, "id", "review", "replyContent", SMALL).validation_metrics is None


def test_a_missing_class_keeps_the_score_vector_whole(reviews):
    few = reviews.where("score < 3")
    model = sentiment.fit_sentiment_model(few, "review", "replyContent", SMALL)
    rows = sentiment.score_sentiment(reviews, model, "review", "replyContent").collect()
    assert all(len(r.probs) == 5 and abs(sum(r.probs) - 1) < 1e-9 for r in rows)


def test_stages_found_on_disk_are_loaded(spark, reviews, tmp_path, monkeypatch):
    paths = whole.Paths(**{n: str(tmp_path / n) for n in ("model", "features", "predictions", "epoch_metrics", "report", "submission")})
    template = reviews.where("split = 'test'").select(F.col("id").cast("string"), F.lit(0).alias("value"))
    settings = small_settings(translate=False, num_trials=1, num_folds=2, boost_rounds=2, all_train=False)
    first = whole.review_run(reviews, settings, paths=paths, template=template)
    expected = sorted(map(str, first.run.evaluation.collect()))
    assert len(spark.read.option("header", True).csv(paths.epoch_metrics).columns) == 7
    assert spark.read.csv(paths.submission).count() == template.count()

    def unexpected(*a, **k):
        raise AssertionError("a kept stage was made again")

    with monkeypatch.context() as patched:  # the same input: nothing is fitted again
        for module, name in [(whole, "fit_sentiment_model"), (whole, "train_sentiment"), (whole, "feature_table")]:
            patched.setattr(module, name, unexpected)
        again = whole.review_run(reviews, settings, paths=paths)
        assert sorted(map(str, again.run.evaluation.collect())) == expected
        other = replace(settings, num_classes=4)
        with pytest.raises(AssertionError, match="made again"):
            whole.review_run(reviews, other, paths=whole.Paths(features=paths.features))
        with pytest.raises(AssertionError, match="made again"):
            whole.review_run(reviews.where("id > 3"), settings, paths=whole.Paths(features=paths.features))


def test_any_regressor_and_class_count(spark, matrix):
    line = regressors.Learner("line", lambda seed, settings: LinearRegression(featuresCol="features", labelCol="score"))
    learners = (line, regressors.LEARNERS[0])
    three = matrix.withColumn("score", F.least("score", F.lit(2)))
    settings = small_settings(num_classes=3, num_trials=1, num_folds=2, weights={"line": 0.25, "boost_a": 0.75})
    got = training.train_ensemble(three, three.select("id", "features"), settings, learners)
    assert {r.label for r in got.votes.collect()} <= {0, 1, 2}
    assert got.test_votes.count() == three.count() and "t3" not in got.validated.cuts.columns
    assert got.evaluation.where("metric = 'qwk'").first().value > 0.8


def test_model_over_token_ids(spark):
    rows = spark.createDataFrame([(1, "a b a", "c"), (2, None, "a"), (3, "b", None)], "id int, review string, reply string")
    vocabulary = encode.build_vocabulary(rows, ["review", "reply"], 10)
    encoded = encode.encode_text_pair(rows, "id", "review", "reply", vocabulary, 12)

    def make_predict():
        import numpy as np

        def predict(review_ids, review_mask, reply_ids, reply_mask):
            return np.stack([review_mask.sum(axis=1), reply_mask.sum(axis=1), (review_ids > 3).sum(axis=1)], axis=1).astype(float)
        return predict

    got = {r.id: r.probs for r in sentiment.score_encoded(encoded, "id", make_predict, 12).collect()}
    assert got == {1: [5.0, 3.0, 3.0], 2: [2.0, 3.0, 0.0], 3: [3.0, 2.0, 1.0]}


def counted(learner, built):
    """The learner, noting how many rounds each of its fits may run."""
    def build(seed, settings):
        built.append((seed, settings.boost_rounds))
        return learner.build(seed, settings)
    return regressors.Learner(learner.name, build, learner.stop_on)


@pytest.mark.parametrize("learner", regressors.LEARNERS[:3], ids=lambda learner: learner.name)
def test_boosting_stops_before_the_maximum(matrix, learner):
    built = []
    train, held = matrix.where("id % 5 != 0"), matrix.where("id % 5 = 0")
    settings = small_settings(boost_rounds=200, patience=4, round_block=4)
    fitted = regressors.fit_learner(counted(learner, built), train, 42, settings, held)
    trees = sum(len(m.treeWeights) for m in fitted.blocks)
    assert trees == sum(rounds for _, rounds in built) < 200 and 1 <= fitted.rounds <= trees - 4
    error = fitted.score(held).agg(F.avg(F.pow(F.col(learner.name) - F.col("score"), 2))).first()[0]
    assert error < 0.2


def test_no_round_is_fitted_beyond_patience(matrix):
    built = []
    train, held = matrix.where("id % 5 != 0"), matrix.where("id % 5 = 0")
    fitted = regressors.fit_learner(counted(regressors.LEARNERS[0], built), train, 42,
                                    small_settings(boost_rounds=200, patience=7, round_block=5), held)
    assert sum(rounds for _, rounds in built) == fitted.rounds + 7


def test_curve_on_the_driver_follows_the_same_rules(spark):
    """``_kappas`` and ``_best_round`` against ``staged_qwk`` and ``best_iteration``."""
    rows = cut(views.staged(spark, "/root/testdata/sf0.001"), "staged")
    counts = regressors.staged_counts(rows, "y", F.col("increments")).groupBy("iter", "y", "p").agg(F.sum("n").alias("n")).collect()
    scores = regressors.staged_qwk(rows, "y", F.col("increments"))
    curve = [r.qwk for r in scores.orderBy("iter").collect()]
    assert regressors._kappas(counts, len(curve)) == pytest.approx(curve, abs=1e-12)
    for curve, patience in [(curve, 10), ([0.1, 0.5, 0.5, 0.4], 100), ([0.1, 0.5, 0.4, 0.3, 0.9], 2), ([0.9, 0.1, 0.1], 1), ([None, None, 0.2], 5)]:
        table = spark.createDataFrame([(i + 1, q) for i, q in enumerate(curve)], "iter int, qwk double")
        assert regressors._best_round(curve, patience) == regressors.best_iteration(table, patience).first().best_iter


def test_blocks_add_up(matrix):
    """The first rounds of several blocks are their predictions' sum."""
    settings = small_settings(boost_rounds=9, patience=100, round_block=3)
    noisy = matrix.withColumn("score", F.col("score") + (F.col("id") % 5).cast("int") - 2)
    fitted = regressors.fit_learner(regressors.LEARNERS[1], noisy, 42, settings, noisy)
    assert len(fitted.blocks) == 3 and 7 <= fitted.rounds <= 9
    both = regressors.Fitted("two", fitted.blocks, 5).score(regressors.Fitted("one", fitted.blocks, 3).score(matrix))
    steps = regressors.round_contributions(fitted.blocks[1])
    after = regressors._with_leaves(fitted.blocks[1], both).withColumn("sum", F.col("one") + steps[0] + steps[1])
    assert after.where(F.abs(F.col("sum") - F.col("two")) > 1e-9).count() == 0


def test_small_fits_overlap_until_all_cores_are_busy(spark):
    cores = spark.sparkContext.defaultParallelism
    assert training._at_a_time(spark, Settings(), 100) == 2 * cores
    assert training._at_a_time(spark, Settings(), 10**9) == 4
    assert training._at_a_time(spark, Settings(fit_threads=3), 100) == 3


def test_a_large_table_in_few_files_is_dealt_out_to_all_cores(spark, monkeypatch):
    rows, cores = spark.range(0, 1000, 1, 1), spark.sparkContext.defaultParallelism
    monkeypatch.setattr(regressors, "ROWS_PER_TASK", 10)
    dealt = regressors.for_fit(rows, 1000)
    assert dealt.rdd.getNumPartitions() == 2 * cores and dealt.count() == 1000
    assert regressors.for_fit(rows, 30).rdd.getNumPartitions() == 3
    assert regressors.for_fit(spark.range(0, 30, 1, 8), 30).rdd.getNumPartitions() == 3


def test_a_forest_of_few_nodes_a_pass_has_the_same_trees(matrix, monkeypatch):
    forest, settings, trees = regressors.LEARNERS[3], small_settings(forest_trees=60), []
    asked = []
    copy = regressors.RandomForestRegressor.copy
    monkeypatch.setattr(regressors.RandomForestRegressor, "copy", lambda self, extra=None: (asked.append(extra), copy(self, extra))[1])
    for many in (10**9, 1):
        monkeypatch.setattr(regressors, "MANY_ROWS", many)
        model = regressors.fit_learner(forest, matrix, 42, settings).blocks[0]
        trees.append(model.toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1] and [list(extra.values()) for extra in asked if extra] == [[1]]
    own = regressors.RandomForestRegressor(maxMemoryInMB=64, featureSubsetStrategy="all")
    assert regressors._few_nodes(own, matrix) is own


def test_every_learner_gets_its_trials_seed(matrix):
    built = []
    learners = tuple(counted(learner, built) for learner in regressors.LEARNERS)
    settings = small_settings(num_folds=2, boost_rounds=1, patience=1, round_block=1, fit_threads=1)
    training.oof_predictions(training._folded(matrix, settings), settings, {0: 42, 1: 84}, learners)
    assert sorted({seed for seed, _ in built}) == [42, 84] and len(built) == 2 * 2 * 4


def test_a_stopped_run_goes_on_where_it_was(matrix, tmp_path):
    built = []
    learners = (counted(regressors.LEARNERS[3], built),)
    settings = small_settings(num_folds=2, forest_trees=2, fit_threads=1)
    folded = training._folded(matrix, settings)
    first = training.oof_predictions(folded, settings, {0: 42}, learners, str(tmp_path / "oof"))
    expected = sorted(map(str, first.collect()))
    assert len(built) == 2 * 2  # once to describe the learner of each fold, once to fit it
    next((tmp_path / "oof").glob("manifest-*.json")).unlink()  # one fold did not get to its end
    again = training.oof_predictions(folded, settings, {0: 42}, learners, str(tmp_path / "oof"))
    assert sorted(map(str, again.collect())) == expected and len(built) == 4 + 2 + 1


def test_runs_on_one_path_do_not_mix(spark, matrix, tmp_path):
    """Other folds (both ways), seeds, learners, rounds or rows: each run gets what it would get alone."""
    path, forest = str(tmp_path / "oof"), regressors.LEARNERS[3:]
    base = small_settings(num_folds=3, forest_trees=2, forest_depth=3)
    deeper = replace(base, forest_depth=4)
    fewer = matrix.where("id % 7 != 0")
    other = matrix.withColumn("score", F.when(F.col("id") == matrix.first().id, F.lit(0)).otherwise(F.col("score")))
    line = (regressors.Learner("forest", lambda seed, settings: LinearRegression(featuresCol="features", labelCol="score")),)
    runs = [(matrix, base, {0: 42}, forest), (matrix, replace(base, num_folds=2), {0: 42}, forest),
            (matrix, replace(base, num_folds=4), {0: 42}, forest), (matrix, base, {0: 7}, forest), (matrix, deeper, {0: 42}, forest),
            (fewer, base, {0: 42}, forest), (other, base, {0: 42}, forest), (matrix, base, {0: 42}, line), (matrix, base, {0: 42}, forest)]
    for rows, settings, seeds, learners in runs:
        folded = training._folded(rows, settings)
        shared = training.oof_predictions(folded, settings, seeds, learners, path).collect()
        alone = training.oof_predictions(folded, settings, seeds, learners).collect()
        assert sorted(map(str, shared)) == sorted(map(str, alone))
        assert {r.fold for r in shared} == set(range(settings.num_folds)) and len(shared) == rows.count()


def test_more_trials_use_those_that_are_there(matrix, tmp_path):
    built = []
    learners = (counted(regressors.LEARNERS[3], built),)
    settings = small_settings(num_folds=2, forest_trees=2)
    folded, path = training._folded(matrix, settings), str(tmp_path / "oof")
    training.oof_predictions(folded, settings, {0: 42}, learners, path)
    built.clear()
    got = training.oof_predictions(folded, settings, {0: 42, 1: 84}, learners, path)
    assert [seed for seed, _ in built].count(42) == 2 and [seed for seed, _ in built].count(84) == 4
    assert got.groupBy("trial").count().where(F.col("count") == matrix.count()).count() == 2


def test_one_folds_models_at_most_score_a_table(matrix, monkeypatch):
    widths = []
    monkeypatch.setattr(training, "_write_scores", lambda df, fitted, keep, path, **at: widths.append([f.name for f in fitted]))
    monkeypatch.setattr(training, "_scores", lambda *a: matrix.withColumn("trial", F.lit(0)))
    settings = small_settings(num_folds=2, boost_rounds=1, patience=1, round_block=1)
    training.oof_predictions(training._folded(matrix, settings), settings, {0: 42, 1: 84})
    assert widths == [list(MODEL_WEIGHTS)] * 4


def test_refits_run_the_mean_of_the_kept_rounds(spark, matrix):
    built = []
    learners = (counted(regressors.LEARNERS[0], built),)
    kept = spark.createDataFrame([(0, 0, {"boost_a": 2}), (0, 1, {"boost_a": 5})], "trial int, fold int, rounds map<string, int>")
    settings = small_settings(refit_rounds="mean_best")
    training.refit_predictions(matrix, matrix.drop("score"), settings, {0: 42}, learners, kept)
    assert built in ([(42, 3)], [(42, 4)])


def test_missing_values_are_imputed_with_indicators(spark):
    rows = spark.createDataFrame([(1, None, 0.5), (2, 4, None)], "id int, days_to_reply long, review_importance double")
    got = regressors.impute(rows, features.IMPUTED).orderBy("id").collect()
    assert [(r.days_to_reply, r.days_missing, r.review_importance, r.importance_missing) for r in got] == [(-1, 1, 0.5, 0), (4, 0, -1.0, 1)]


def test_a_run_with_missing_numbers(reviews):
    holes = reviews.withColumn("thumbsUpCount", F.when(F.col("id") % 3 != 0, F.col("thumbsUpCount")))
    settings = small_settings(translate=False, num_trials=1, num_folds=2, boost_rounds=2, round_block=2)
    assert whole.review_run(holes, settings).submission.count() == reviews.where("split = 'test'").count()


def test_repeated_and_missing_ids_are_refused(spark, reviews):
    for wrong in (reviews.unionByName(reviews.limit(1)), reviews.withColumn("id", F.when(F.col("id") > 0, F.col("id")))
                  .unionByName(reviews.limit(1).withColumn("id", F.lit(None).cast("long")))):
        with pytest.raises(ValueError, match="unique and not null"):
            whole.review_run(wrong, small_settings(translate=False))


def test_text_stages_are_fitted_once(reviews, monkeypatch):
    fits = []
    real = sentiment.fit_text_stages
    monkeypatch.setattr(sentiment, "fit_text_stages", lambda *a: fits.append(1) or real(*a))
    sentiment.train_sentiment(reviews.where("split = 'train'"), "id", "review", "replyContent", small_settings(all_train=False))
    assert fits == [1]


def test_plugged_in_detector_sees_each_text_once(spark):
    from ordinalis.operators import language

    rows = spark.createDataFrame([(i, ["a", "bb", None][i % 3]) for i in range(30)], "id int, review string")
    got = language.detect_with(rows, "review", lambda: lambda texts: ["x" if len(t) == 1 else "y" for t in texts]).collect()
    assert {(r.review, r.language) for r in got} == {("a", "x"), ("bb", "y"), (None, "unknown")} and len(got) == 30


def test_translated_stage_is_kept(spark, reviews, tmp_path):
    paths = whole.Paths(translated=str(tmp_path / "translated"))
    models = whole.PlugIns(lambda: lambda texts: ["fr"] * len(texts), lambda texts, lang: [t.upper() for t in texts])
    made, working = whole.prepare_text(reviews, Settings(), paths=paths, plug_ins=models)
    assert working == "translated_review" and made.where("translated_review != upper(review)").count() == 0
    calls = []
    noted = whole.PlugIns(models.detector, lambda texts, lang: calls.append(1) or texts, version="1")
    named = lambda: whole.PlugIns(models.detector, lambda texts, lang: [t.upper() for t in texts], version="2")
    assert whole.prepare_text(reviews, Settings(), paths=paths, plug_ins=models)[0].count() == reviews.count()
    folders = lambda: len(list((tmp_path / "translated").glob("data-*")))
    assert folders() == 1
    empty, _ = whole.prepare_text(reviews.where("1 = 0"), Settings(), paths=paths, plug_ins=models)
    assert empty.count() == 0 and folders() == 2  # another input is another stage
    same, _ = whole.prepare_text(reviews, Settings(), paths=paths, plug_ins=noted)
    assert same.where("translated_review != review").count() == 0 and folders() == 3  # and so is another model
    for _ in range(2):
        whole.prepare_text(reviews, Settings(), paths=paths, plug_ins=named())
    assert folders() == 4  # a version tells models apart, whatever they pickle to


def test_learners_can_be_plugged_into_the_whole_run(reviews):
    line = lambda name: regressors.Learner(name, lambda seed, settings: LinearRegression(featuresCol="features", labelCol="score"))
    settings = small_settings(translate=False, num_trials=1, num_folds=2, weights={"one": 0.5, "two": 0.5})
    result = whole.review_run(reviews, settings, plug_ins=whole.PlugIns(learners=(line("one"), line("two"))))
    assert result.submission.count() == reviews.where("split = 'test'").count()
    with pytest.raises(ValueError, match="must name the learners"):
        whole.review_run(reviews, small_settings(translate=False), plug_ins=whole.PlugIns(learners=(line("one"),)))


def test_refitted_rounds_are_those_the_folds_kept(spark, monkeypatch):
    """The registered query: no booster runs a number of rounds that no validation fold has found."""
    from ordinalis.catalog import queries

    kept, refitted = {}, {}
    fit = regressors.fit_learner

    def noted(learner, train, seed, settings, validation=None, rounds=None):
        fitted = fit(learner, train, seed, settings, validation, rounds)
        if learner.stop_on and validation is not None:
            kept.setdefault(learner.name, []).append(fitted.rounds)
        elif learner.stop_on:
            refitted[learner.name] = fitted.rounds
        return fitted

    monkeypatch.setattr(regressors, "fit_learner", noted)
    monkeypatch.setattr(training, "fit_learner", noted)
    monkeypatch.setattr(queries, "QUERY_SETTINGS", small_settings(refit_rounds="mean_best", boost_rounds=8, patience=4))
    rows = queries.QUERIES["predict_test"](spark, "/root/testdata/sf0.001").collect()
    assert {r.model for r in rows} == set(MODEL_WEIGHTS) and all(r.in_range for r in rows)
    assert {name: max(1, round(np.mean(n))) for name, n in kept.items()} == refitted and len(refitted) == 3
    assert all(len(n) == 3 for n in kept.values())


def test_registered_queries_keep_the_full_patience():
    """Only folds, trials and the rounds of refits are smaller than in ``Settings``."""
    from dataclasses import asdict

    from ordinalis.catalog.queries import QUERY_SETTINGS

    full, used = asdict(Settings()), asdict(QUERY_SETTINGS)
    assert {name for name in full if full[name] != used[name]} == {"num_trials", "num_folds", "refit_rounds"}


def constant_columns(df, **more):
    rounds = F.create_map(*[F.lit(x) for name in MODEL_WEIGHTS for x in (name, 1)])
    return df.withColumns({name: F.lit(2.0) for name in MODEL_WEIGHTS} | {"rounds": rounds, "trial": F.lit(0)} | more)


def test_queries_tell_a_constant_regressor(spark, monkeypatch):
    from ordinalis.catalog.queries import QUERIES

    class Constant:
        def __init__(self, name):
            self.name, self.rounds = name, 5

        def score(self, df):
            return df.withColumn(self.name, F.lit(2.0))

    def refused(name, column):
        rows = QUERIES[name](spark, "/root/testdata/sf0.001")
        return rows.count() > 0 and rows.where(column).count() == 0

    monkeypatch.setattr(regressors, "fit_learner", lambda learner, *a: Constant(learner.name))
    assert all(refused(f"fit_{learner.name}", "explains") for learner in regressors.LEARNERS)
    monkeypatch.setattr(training, "oof_predictions", lambda folded, *a, **k: constant_columns(folded.drop("features")))
    monkeypatch.setattr(training, "refit_predictions", lambda train, test, *a, **k: constant_columns(test.select("id")))
    assert refused("kfold_oof", "agrees") and refused("predict_test", "explains")
    assert refused("train_ensemble", "metric = 'qwk' AND agrees") and refused("train_ensemble", "test_agrees")


def test_blocks_are_as_long_as_patience_is_sure_to_look(matrix):
    """The first block has a round more than patience, the next ones end where patience would."""
    built = []
    noisy = matrix.withColumn("score", F.col("score") + (F.col("id") % 5).cast("int") - 2)
    settings = small_settings(boost_rounds=30, patience=6, round_block=None)
    fitted = regressors.fit_learner(counted(regressors.LEARNERS[1], built), noisy, 42, settings, noisy.where("id % 5 = 0"))
    sizes = [rounds for _, rounds in built]
    assert sizes[0] == 7 and sum(sizes) == min(30, fitted.rounds + 6)
    assert all(size <= 6 for size in sizes[1:])  # no block runs past the patience of its best round
