"""One query per operator, each over whole tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordinalis.catalog import views
from ordinalis.functions import ordinal, text as tx, vectors
from ordinalis.operators import agreement, encode, ensemble, language, ranks, refine, regressors, sentiment, thresholds, translate
from ordinalis.operators.memo import Memo
from ordinalis.plans import features, review_run as whole, training
from ordinalis.schema import FLAG_COLUMNS, onehot_names, prob_names
from ordinalis.settings import MODEL_WEIGHTS, START_THRESHOLDS, Settings
from ordinalis.sources import readers, writers
from ordinalis.storage import cut, fresh_path, names_in, size_of
from ordinalis.streaming import arrivals, scoring, voting

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Parameters of the registered model queries. Everything else is as in ``Settings``: up to 1,000
#: boosting rounds, patience 100, 80 trees of depth 7, 20 classifier iterations, 65,536 hashed
#: features. Fewer folds and trials, and refits of as many rounds as the folds kept, so that a query
#: ends in minutes on one machine; all rows take part in each.
QUERY_SETTINGS = Settings(num_trials=2, num_folds=3, refit_rounds="mean_best")
CV = ["trial", "fold"]
ORDER_COLUMNS = ["sum_qty", "avg_disc", "max_tax", "n_lines"]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _round(column: Column | str, digits: int = 6) -> Column:
    """Rounded, and without a negative zero, for comparing floats between engines."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)


# --- sources and sinks -------------------------------------------------------------------

def _review_columns(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in readers.REVIEW_SCHEMA.fields])


def _csv_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "reviews-csv")
    writers.write_features_csv(_review_columns(views.reviews(spark, sf_dir)), path)
    return readers.load_reviews(spark, path)


@query
def load_reviews(spark, sf_dir):
    return _csv_reviews(spark, sf_dir)


@query
def load_reviews_by_name(spark, sf_dir):
    """Another column order, the label written as 4.0, and the optional columns."""
    rows = views.reviews(spark, sf_dir)
    path = fresh_path(spark, "reviews-csv")
    writers.write_features_csv(rows.select("replyContent", F.col("score").cast("double").alias("score"), "timeToReply", "review",
                                           F.col("replyContent").alias("translated_review"), "thumbsUpCount", "id",
                                           "reviewCreatedVersion", F.lit("en").alias("language")), path)
    return readers.load_reviews(spark, path)


#: Reviews in one file, and bytes that one task reads, of ``load_reviews_split``.
REVIEWS_PER_FILE = 250_000
BYTES_PER_TASK = 8 << 20


@query
def load_reviews_split(spark, sf_dir):
    """Large files (one, up to 250,000 reviews), read in splits of 16 KB that cut through cells with line
    breaks. A task reads many splits, each on its own: a task a split would spend its time on starting."""
    path = fresh_path(spark, "reviews-csv")
    rows = cut(_review_columns(views.reviews(spark, sf_dir)), "reviews")
    writers.write_features_csv(rows.coalesce(max(1, math.ceil(rows.count() / REVIEWS_PER_FILE))), path)
    tasks = max(2 * spark.sparkContext.defaultParallelism, math.ceil(size_of(spark, path) / BYTES_PER_TASK))
    settings = {"spark.sql.files.maxPartitionBytes": 16 << 10, "spark.sql.files.maxPartitionNum": tasks}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        return cut(readers.load_reviews(spark, path, split_files=True), "reviews")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@query
def union_train_test(spark, sf_dir):
    train, test = readers.split_train_test(views.reviews(spark, sf_dir))
    return readers.union_train_test(train.drop("split"), test.drop("split", "score"))


def _template(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "template")
    test = readers.split_train_test(views.reviews(spark, sf_dir))[1]
    writers.write_submission(test.select("id", F.lit(0).alias("value")), path)
    return readers.load_submission_template(spark, path)


@query
def load_submission_template(spark, sf_dir):
    return _template(spark, sf_dir)


@query
def materialize_or_load(spark, sf_dir):
    path = fresh_path(spark, "stage")
    build = lambda: views.reviews(spark, sf_dir).select("id", "split", "score")
    readers.materialize_or_load(spark, path, build)

    def unexpected():
        raise AssertionError("a finished stage was built again")

    return readers.materialize_or_load(spark, path, unexpected)


@query
def sink_features(spark, sf_dir):
    path = fresh_path(spark, "features")
    writers.write_features(feature_table(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def sink_epoch_metrics(spark, sf_dir):
    path = fresh_path(spark, "epochs")
    writers.write_epoch_metrics(_epoch_metrics(spark, sf_dir), path)
    back = spark.read.schema("epoch int, train_loss double, train_accuracy double, train_qwk double")
    return back.option("header", True).csv(path).select("epoch", *[
        _round(c).alias(c) for c in ("train_loss", "train_accuracy", "train_qwk")])


@query
def sink_report(spark, sf_dir):
    path = fresh_path(spark, "report")
    writers.write_report(evaluate_run(spark, sf_dir), path)
    return spark.read.schema("metric string, class string, value double").json(path)


@query
def submission(spark, sf_dir):
    test = readers.split_train_test(views.reviews(spark, sf_dir))[1]
    made = test.select("id", (F.col("thumbsUpCount") % 5).cast("int").alias("label"))
    path = fresh_path(spark, "submission")
    writers.write_submission(writers.submission(_template(spark, sf_dir), made), path)
    return readers.load_submission_template(spark, path)


@query
def model_roundtrip(spark, sf_dir):
    rows = cut(views.reviews(spark, sf_dir), "reviews")
    model = sentiment.fit_sentiment_model(rows, "review", "replyContent", QUERY_SETTINGS)
    path = fresh_path(spark, "model")
    writers.save_model(model, path)
    before = sentiment.score_sentiment(rows, model, "review", "replyContent").select("id", "probs")
    after = sentiment.score_sentiment(rows, writers.load_model(spark, path), "review", "replyContent")
    return before.join(after.select("id", F.col("probs").alias("reloaded")), "id").select(
        "id", (F.col("probs") == F.col("reloaded")).alias("equal"))


# --- projections ---------------------------------------------------------------------------

@query
def clean_text(spark, sf_dir):
    return views.reviews(spark, sf_dir).select("id", tx.replace_keywords(F.col("review")).alias("text"))


@query
def fill_text_nulls(spark, sf_dir):
    return views.reviews(spark, sf_dir).select(
        "id", *[tx.fill_null(F.col(c)).alias(c) for c in ("review", "replyContent")])


@query
def emoji_override(spark, sf_dir):
    raw = F.col("review")
    return views.reviews(spark, sf_dir).select(
        "id", F.when(tx.is_emoji_only(raw), F.lit("great")).otherwise(raw).alias("text"))


@query
def select_model_columns(spark, sf_dir):
    return features.select_model_columns(features.text_features(views.reviews(spark, sf_dir))).select(
        "id", "split", "days_to_reply", *FLAG_COLUMNS, _round("review_importance").alias("review_importance"))


@query
def split_train_test(spark, sf_dir):
    train, test = readers.split_train_test(views.reviews(spark, sf_dir))
    part = lambda df, name: df.select(F.lit(name).alias("part"), "id", "score")
    return part(train, "train").unionByName(part(test, "test"))


@query
def days_to_reply(spark, sf_dir):
    return views.reviews(spark, sf_dir).select("id", tx.leading_days(F.col("timeToReply")).alias("days_to_reply"))


@query
def text_flags(spark, sf_dir):
    return features.text_features(views.reviews(spark, sf_dir)).select("id", *FLAG_COLUMNS)


@query
def review_length(spark, sf_dir):
    return features.text_features(views.reviews(spark, sf_dir)).select("id", "review_length")


@query
def review_importance(spark, sf_dir):
    return features.text_features(views.reviews(spark, sf_dir)).select(
        "id", _round("review_importance").alias("review_importance"))


def _epoch_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.epoch_logits(spark, sf_dir).withColumn("probs", vectors.softmax(F.col("logits"), 5))


@query
def prob_columns(spark, sf_dir):
    wide = _epoch_probs(spark, sf_dir).select("epoch", "id", *vectors.probability_columns(F.col("probs"), 5))
    return wide.select("epoch", "id", *[_round(F.col(f"`{c}`")).alias(c) for c in prob_names(5)])


@query
def sentiment_onehot(spark, sf_dir):
    return views.epoch_logits(spark, sf_dir).select(
        "epoch", "id", *vectors.one_hot(vectors.argmax(F.col("logits")), 5))


@query
def route_language(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", translate.route_language(F.col("lang"), F.col("text"),
                                           F.concat(F.lit("> "), F.col("text"))).alias("routed"))


@query
def working_text(spark, sf_dir):
    rows = views.reviews(spark, sf_dir).select("id", "review", F.lit("x").alias("language"),
                                               F.col("replyContent").alias("translated_review"))
    prepared, working = whole.prepare_text(rows, Settings())
    return prepared.select("id", F.col(working).alias("text"), *[c for c in prepared.columns if c == "language"])


@query
def profile_features(spark, sf_dir):
    return features.profile_features(features.text_features(views.reviews(spark, sf_dir)).select(
        "id", "score", "days_to_reply", *FLAG_COLUMNS, "review_length", "review_importance"))


@query
def feature_table(spark, sf_dir):
    return features.text_features(views.reviews(spark, sf_dir)).select(
        "id", "split", "score", "text", "replyContent", "days_to_reply", *FLAG_COLUMNS, "review_length",
        _round("review_importance").alias("review_importance"))


def _in_two_runs(spark: SparkSession, name: str, rows: DataFrame, first: Column, run) -> None:
    """``run(stream)`` on the rows of ``first``, whose files arrive a third at a time, then, started
    anew, on the rest. The files are those that tasks write, whatever a key's share is."""
    source, seen = fresh_path(spark, name), 0
    for part in (first, ~first):
        rows.where(part).write.mode("append").option("maxRecordsPerFile", 50_000).parquet(source)
        files = sum(file.endswith(".parquet") for file in names_in(spark, source))
        new, seen = files - seen, files
        run(arrivals.arriving(spark, source, rows.schema, max(1, math.ceil(new / 3)))).awaitTermination()


@query
def feature_table_stream(spark, sf_dir):
    """``feature_table`` of reviews that arrive in files, with a restart halfway: each row once."""
    made, checkpoint = fresh_path(spark, "streamed-features"), fresh_path(spark, "stream-checkpoint")
    names = ["id", "split", "score", "text", "replyContent", "days_to_reply", *FLAG_COLUMNS, "review_length", "review_importance"]

    def run(stream):
        return scoring.write_scores(features.text_features(stream).select(*names), made, checkpoint)

    _in_two_runs(spark, "arriving-reviews", views.reviews(spark, sf_dir), F.col("id") % 3 == 0, run)
    return spark.read.parquet(made).withColumn("review_importance", _round("review_importance"))


# --- text model stages ---------------------------------------------------------------------

def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


def _profile(spark: SparkSession, sf_dir: str) -> language.LanguageProfile:
    return language.fit_language_profile(_documents(spark, sf_dir))


@query
def detect_language(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return language.detect_language(docs, "doc_id", "text", _profile(spark, sf_dir))


@query
def language_accuracy(spark, sf_dir):
    """Every document judged by a profile that hasn't seen it."""
    docs = _documents(spark, sf_dir)
    found = language.cross_fit_language(docs, "doc_id")
    return language.language_confusion(docs.select("doc_id", "lang").join(found, "doc_id"))


@query
def translate_reviews(spark, sf_dir):
    rows = views.reviews(spark, sf_dir).withColumn("language", F.lit("to be dropped"))
    out = translate.translate_reviews(rows, "id", "review", _profile(spark, sf_dir), views.lexicon(spark))
    return out.select(*[c for c in out.columns if c in ("id", "review", "translated_review", "language")])


@query
def translate_memo(spark, sf_dir):
    """All documents translated, then again after every hundredth was edited: the second
    translator, told apart by its mark, is given the new texts only."""
    memo = Memo(fresh_path(spark, "memo"), "marking translator")
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    edited = docs.withColumn("text", F.when(F.col("doc_id") % 100 == 0, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text")))
    first = translate.translate_with(docs, "text", "lang", lambda texts, lang: ["first: " + t for t in texts], memo)
    cut(first.select("doc_id", "translated_review", "translate_error"), "translated")
    again = translate.translate_with(edited, "text", "lang", lambda texts, lang: ["second: " + t for t in texts], memo)
    return again.select("doc_id", "translated_review", "translate_error")


@query
def encode_text_pair(spark, sf_dir):
    rows = views.reviews(spark, sf_dir).select("id", "review", "replyContent")
    vocabulary = encode.build_vocabulary(rows, ["review", "replyContent"], Settings().vocab_size)
    ids = encode.encode_text_pair(rows, "id", "review", "replyContent", vocabulary, Settings().max_length)
    return ids.select("id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
                              for c in ("review_ids", "review_mask", "reply_ids", "reply_mask")])


def _fitted_sentiment(spark: SparkSession, sf_dir: str):
    rows = cut(views.reviews(spark, sf_dir), "reviews")
    train = readers.split_train_test(rows)[0]
    return rows, sentiment.fit_sentiment_model(train, "review", "replyContent", QUERY_SETTINGS)


# Model queries state properties that SQL can say too: a fitted value has no other oracle.

@query
def fit_sentiment_model(spark, sf_dir):
    losses = sentiment.loss_history(_fitted_sentiment(spark, sf_dir)[1])
    falling = all(b <= a for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]
    return (views.reviews(spark, sf_dir).where("score is not null and split = 'train'").agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumns({"falling": F.lit(falling), "within_limit": F.lit(len(losses) <= QUERY_SETTINGS.sentiment_iterations + 1)}))


@query
def train_sentiment(spark, sf_dir):
    """The classifier's training with a holdout: metrics of both parts after each epoch."""
    train = readers.split_train_test(views.reviews(spark, sf_dir))[0]
    done = sentiment.train_sentiment(train, "id", "review", "replyContent", replace(QUERY_SETTINGS, all_train=False))
    path = fresh_path(spark, "training-metrics")
    writers.write_epoch_metrics(done.train_metrics, path, done.validation_metrics)
    measures = [f"{part}_{m}" for part in ("train", "val") for m in ("loss", "accuracy", "qwk")]
    back = spark.read.schema("epoch int, " + ", ".join(f"{m} double" for m in measures)).option("header", True).csv(path)
    return back.select("epoch", *[(F.col(m) > 0 if m.endswith("loss") else F.abs(m) <= 1).alias(f"{m}_valid") for m in measures])


def _is_distribution(probs: Column) -> Column:
    total = F.aggregate(probs, F.lit(0.0), lambda a, b: a + b)
    return (F.abs(total - 1) < 1e-9) & F.forall(probs, lambda p: (p >= 0) & (p <= 1))


@query
def score_sentiment(spark, sf_dir):
    rows, model = _fitted_sentiment(spark, sf_dir)
    scored = sentiment.score_sentiment(rows, model, "review", "replyContent")
    return scored.select("id", F.size("probs").alias("classes"), _is_distribution(F.col("probs")).alias("distribution"))


@query
def pca_features(spark, sf_dir):
    rows, model = _fitted_sentiment(spark, sf_dir)
    scored = sentiment.score_sentiment(rows, model, "review", "replyContent")
    wide = cut(features.score_columns(scored), "probabilities")
    x = sentiment.fit_pca(wide, prob_names(5), 2).apply(wide)
    return x.agg(F.count(F.lit(1)).alias("n_rows"), (F.abs(F.avg("pca_1")) + F.abs(F.avg("pca_2")) < 1e-9).alias("centred"),
                 (F.abs(F.covar_pop("pca_1", "pca_2")) < 1e-9).alias("uncorrelated"),
                 (F.var_pop("pca_1") >= F.var_pop("pca_2")).alias("ordered"))


@query
def scored_feature_table(spark, sf_dir):
    rows, model = _fitted_sentiment(spark, sf_dir)
    table = features.feature_table(rows, model, QUERY_SETTINGS)
    probs, marks = F.array(*[F.col(f"`{c}`") for c in prob_names(5)]), F.array(*onehot_names(5))
    return table.select(
        "id", "split", "score", "text", "replyContent", "days_to_reply", *FLAG_COLUMNS, "review_length",
        _round("review_importance").alias("review_importance"), _is_distribution(probs).alias("distribution"),
        (marks[vectors.argmax(probs)] == 1).alias("marked"), F.aggregate(marks, F.lit(0), lambda a, b: a + b).alias("marks"),
        (F.col("pca_1").isNotNull() & F.col("pca_2").isNotNull()).alias("components"))


def _epoch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    logits = views.epoch_logits(spark, sf_dir)
    judged = logits.select("epoch", "batch", "y", vectors.argmax(F.col("logits")).alias("p"),
                           vectors.smoothed_cross_entropy(F.col("logits"), F.col("y"), 5, 0.3).alias("loss"))
    return agreement.epoch_metrics(judged, "y", "p", "loss", "batch")


@query
def epoch_metrics(spark, sf_dir):
    return _epoch_metrics(spark, sf_dir).select("epoch", *[_round(c).alias(c) for c in ("loss", "accuracy", "qwk")])


@query
def softmax_scores(spark, sf_dir):
    return _epoch_probs(spark, sf_dir).select("epoch", "id", *[
        _round(F.col("probs")[k]).alias(f"p{k}") for k in range(5)])


# --- sampling, splits, seeds -----------------------------------------------------------------

@query
def holdout_split(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return ranks.holdout_split(rows, "id", 0.2, 42)


@query
def kfold_assign(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return ranks.kfold_assign(rows, "id", 10, 42)


@query
def kfold_hash(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return ranks.kfold_hash(rows, "id", 10, 42)


@query
def trial_seeds(spark, sf_dir):
    seeds = F.create_map(*[F.lit(x) for item in enumerate(Settings().trial_seeds()) for x in item])
    return (views.preds(spark, sf_dir).groupBy("trial").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("trial", seeds[F.col("trial")].alias("seed"), "n_rows"))


@query
def batch_assign(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return ranks.batch_assign(rows, "id", 16, 42)


@query
def oof_scatter(spark, sf_dir):
    parts = views.preds(spark, sf_dir).select("trial", "id", "fold", "boost_a")
    return ensemble.oof_scatter(parts).select("trial", "id", "fold", _round("boost_a").alias("boost_a"))


# --- regressors ----------------------------------------------------------------------------------

def _order_matrix(spark: SparkSession, sf_dir: str, score: str = "score") -> DataFrame:
    rows = views.order_features(spark, sf_dir).withColumn("score", F.col(score))
    return cut(regressors.assemble(rows, ORDER_COLUMNS, ["id", "score"]), "order-matrix")


def _holdout(spark: SparkSession, sf_dir: str, score: str = "score") -> tuple[DataFrame, DataFrame]:
    rows = ranks.holdout_split(_order_matrix(spark, sf_dir, score), "id", 0.2, 42)
    return rows.where(~F.col("is_validation")), rows.where("is_validation")


#: A constant prediction has an error of the variance; a fit must leave less than this share of it.
UNEXPLAINED = 0.25
#: Out-of-fold labels must reach this kappa where the label follows from the columns.
LEAST_KAPPA = 0.9


def _fit_query(learner: regressors.Learner) -> Query:
    """A fit of the noisy label, of which boosting must keep several rounds."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, held = _holdout(spark, sf_dir, "noisy")
        train = regressors.for_fit(train, train.count())
        fitted = regressors.fit_learner(learner, train, 42, QUERY_SETTINGS, held)
        made = cut(regressors.predict_long(held, [fitted], ["id", "score"]), "held-out")
        error = made.agg(F.avg(F.pow(F.col("prediction") - F.col("score"), 2)), F.var_pop("score")).first()
        stopped = learner.stop_on is None or 2 <= fitted.rounds < QUERY_SETTINGS.boost_rounds
        return made.select("id", "score", "model", F.col("prediction").between(-1, 5).alias("in_range"),
                           F.lit(error[0] < UNEXPLAINED * error[1]).alias("explains"), F.lit(stopped).alias("stopped"))
    return run


for _learner in regressors.LEARNERS:
    QUERIES[f"fit_{_learner.name}"] = _fit_query(_learner)


@query
def staged_best_iter(spark, sf_dir):
    scores = regressors.staged_qwk(views.staged(spark, sf_dir), "y", F.col("increments"))
    best = regressors.best_iteration(scores, patience=10)
    return best.select(F.col("best_iter").cast("int").alias("best_iter"), _round("best").alias("best"))


def _refitted(train: DataFrame, test: DataFrame, settings: Settings) -> DataFrame:
    """(id, model, prediction, rounds): one trial over the folds finds how many rounds each booster
    keeps, then all learners are refitted on all train rows with the folds' mean."""
    folded = training._folded(train.select("id", "score", "features"), settings)
    seeds = {0: settings.trial_seeds()[0]}
    validated = training.oof_predictions(folded, settings, seeds)
    made = training.refit_predictions(folded.drop("fold"), test, settings, seeds, validated=validated)
    pairs = [F.struct(F.lit(m).alias("model"), F.col(m).alias("prediction"), F.col("rounds")[m].alias("rounds"))
             for m in MODEL_WEIGHTS]
    return made.select("id", F.inline(F.array(*pairs)))


@query
def kfold_oof_kept(spark, sf_dir):
    """Out-of-fold predictions kept at one path: 3 folds, then 2, then 3 again, of which nothing is
    fitted twice. Every run has each row once, in its own folds, with the fit it would have alone."""
    path = fresh_path(spark, "kept-folds")
    matrix = _order_matrix(spark, sf_dir)
    seeds, forest = {0: QUERY_SETTINGS.trial_seeds()[0]}, regressors.LEARNERS[3]
    fits = []

    def build(seed, settings):
        fits.append(seed)
        return forest.build(seed, settings)

    learners = (regressors.Learner(forest.name, build),)
    runs = []
    for run, folds in enumerate((3, 2, 3)):
        settings = replace(QUERY_SETTINGS, num_folds=folds)
        folded = training._folded(matrix, settings)
        fits.clear()
        rows = training.oof_predictions(folded, settings, seeds, learners, path)
        built = len(fits) - folds  # describing a learner builds it once a fold, without fitting
        runs.append(rows.select(F.lit(run).alias("run"), "fold", "id", "forest", F.lit(built).alias("fitted")))
    rows = reduce(DataFrame.unionByName, runs)
    first = runs[0].select("id", "fold", F.col("forest").alias("_first"))
    same = rows.join(first, ["id", "fold"], "left").withColumn("same", F.col("run") == 1)
    return (same.groupBy("run", "fold").agg(
        F.count("id").alias("n"), F.count_distinct("id").alias("ids"), F.max("fitted").cast("int").alias("fitted"),
        F.bool_and(F.col("same") | (F.col("forest") == F.col("_first"))).alias("as_first")))


@query
def predict_test(spark, sf_dir):
    """All learners refitted on the train rows, with the folds' mean best rounds."""
    train, test = _holdout(spark, sf_dir)
    made = cut(_refitted(train, test, QUERY_SETTINGS).join(test.select("id", "score"), "id"), "predicted-test")
    error = made.groupBy("model").agg(F.avg(F.pow(F.col("prediction") - F.col("score"), 2)).alias("error"),
                                      F.var_pop("score").alias("variance"))
    explains = error.select("model", (F.col("error") < UNEXPLAINED * F.col("variance")).alias("explains"))
    return made.join(explains, "model").select("id", "model", F.col("prediction").between(-1, 5).alias("in_range"), "explains")


@query
def impute_days(spark, sf_dir):
    rows = features.text_features(views.reviews(spark, sf_dir))
    return regressors.impute_days(rows).select("id", "days_to_reply", "days_missing")


# --- ensemble and evaluation -----------------------------------------------------------------------

def _combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensemble.ensemble_weighted(views.preds(spark, sf_dir), MODEL_WEIGHTS)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _combined(spark, sf_dir).withColumn("label", ordinal.digitize(F.col("prediction"), START_THRESHOLDS))


@query
def ensemble_weighted(spark, sf_dir):
    return _combined(spark, sf_dir).select("trial", "id", _round("prediction").alias("prediction"))


@query
def ensemble_long(spark, sf_dir):
    pairs = [F.struct(F.lit(m).alias("model"), F.col(m).alias("prediction")) for m in MODEL_WEIGHTS]
    rows = views.preds(spark, sf_dir).select("trial", "id", F.inline(F.array(*pairs)))
    return ensemble.ensemble_long(rows, MODEL_WEIGHTS, ["trial", "id"]).select(
        "trial", "id", _round("prediction").alias("prediction"))


@query
def digitize(spark, sf_dir):
    return _labelled(spark, sf_dir).select("trial", "id", "label")


@query
def qwk(spark, sf_dir):
    by_fold = agreement.qwk(_labelled(spark, sf_dir), "y", "label", CV)
    return by_fold.select(*CV, _round("qwk", 9).alias("qwk"))


@query
def qwk_fixed(spark, sf_dir):
    by_fold = agreement.qwk(_labelled(spark, sf_dir), "y", "label", CV, labels="fixed")
    return by_fold.select(*CV, _round("qwk", 9).alias("qwk"))


@query
def qwk_missing_class(spark, sf_dir):
    """Both modes where classes 2 and 3 never occur, so that they differ."""
    sparse = lambda c: F.when(F.col(c) < 2, F.col(c)).otherwise(F.lit(4))
    rows = _labelled(spark, sf_dir).select("trial", sparse("y").alias("y"), sparse("label").alias("label"))
    present = agreement.qwk(rows, "y", "label", ["trial"]).withColumnRenamed("qwk", "present")
    fixed = agreement.qwk(rows, "y", "label", ["trial"], labels="fixed").withColumnRenamed("qwk", "fixed")
    return present.join(fixed, "trial").select("trial", *[_round(c, 9).alias(c) for c in ("present", "fixed")])


@query
def qwk_rounded(spark, sf_dir):
    rows = views.preds(spark, sf_dir).withColumn("p", ordinal.round_half_even(F.col("boost_a")))
    return agreement.qwk(rows, "y", "p", CV).select(*CV, _round("qwk", 9).alias("qwk"))


def _searched(rows: DataFrame, labels: str) -> DataFrame:
    """Per group: whether the reported kappa is that of the cut labels, is no worse than the start
    vector's, and the cuts are in order."""
    cuts = cut(thresholds.optimize_thresholds(rows, "y", "prediction", CV, labels=labels), "searched-cuts")
    made = ensemble.cut_at(rows, cuts, CV).withColumn("start", ordinal.digitize(F.col("prediction"), START_THRESHOLDS))
    kappa = lambda p: agreement.qwk(made, "y", p, CV, labels=labels).withColumnRenamed("qwk", f"_{p}")
    order = F.array(*[f"t{i}" for i in (1, 2, 3, 4)])
    return cuts.join(kappa("label"), CV).join(kappa("start"), CV).select(
        *CV, (F.abs(F.col("qwk") - F.col("_label")) < 1e-9).alias("recomputed"),
        (F.col("qwk") >= F.col("_start") - 1e-9).alias("no_worse"), (F.array_sort(order) == order).alias("ordered"))


@query
def optimize_thresholds(spark, sf_dir):
    return _searched(_combined(spark, sf_dir), "present")


@query
def optimize_thresholds_fixed(spark, sf_dir):
    return _searched(_combined(spark, sf_dir), "fixed")


@query
def optimize_thresholds_missing_class(spark, sf_dir):
    """Labels 2 and 3 never occur, so the two numberings differ."""
    return _searched(_combined(spark, sf_dir).withColumn("y", F.when(F.col("y") < 2, F.col("y")).otherwise(F.lit(4))), "present")


@query
def refine_thresholds(spark, sf_dir):
    """Per trial: the checks of ``optimize_thresholds``, and no less than the cuts on edges of 1/256 reach."""
    rows = cut(_combined(spark, sf_dir), "combined")
    fine = cut(refine.refine_thresholds(rows, "y", "prediction", ["trial"]), "refined-cuts")
    coarse = thresholds.optimize_thresholds(rows, "y", "prediction", ["trial"]).select("trial", F.col("qwk").alias("_coarse"))
    made = ensemble.cut_at(rows, fine, ["trial"])
    again = agreement.qwk(made, "y", "label", ["trial"]).withColumnRenamed("qwk", "_again")
    order = F.array(*[f"t{i}" for i in (1, 2, 3, 4)])
    return fine.join(coarse, "trial").join(again, "trial").select(
        "trial", (F.abs(F.col("qwk") - F.col("_again")) < 1e-9).alias("recomputed"),
        (F.col("qwk") >= F.col("_coarse") - 1e-12).alias("no_worse"), (F.array_sort(order) == order).alias("ordered"))


@query
def threshold_tail_sums(spark, sf_dir):
    histogram = thresholds.threshold_histogram(_combined(spark, sf_dir), "y", "prediction", CV)
    return thresholds.threshold_tail_sums(histogram, CV)


@query
def threshold_candidates(spark, sf_dir):
    found = thresholds.threshold_candidates(_combined(spark, sf_dir), "y", "prediction", CV)
    return found.select(*CV, "k", "bin", _round("qwk", 9).alias("qwk"))


def _swept_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.best_candidates(
        thresholds.threshold_candidates(_combined(spark, sf_dir), "y", "prediction", CV), CV)


@query
def best_candidates(spark, sf_dir):
    return _swept_cuts(spark, sf_dir)


@query
def mean_thresholds(spark, sf_dir):
    means = thresholds.mean_thresholds(_swept_cuts(spark, sf_dir), ["trial"])
    return means.select("trial", *[_round(f"t{i}", 9).alias(f"t{i}") for i in (1, 2, 3, 4)])


@query
def vote_mode(spark, sf_dir):
    return ensemble.vote_mode(_labelled(spark, sf_dir), ["id"])


@query
def accuracy(spark, sf_dir):
    return agreement.accuracy(_labelled(spark, sf_dir), "y", "label", CV).select(*CV, _round("accuracy", 9).alias("accuracy"))


@query
def classification_report(spark, sf_dir):
    report = agreement.classification_report(_labelled(spark, sf_dir), "y", "label", by=["trial"])
    return report.select("trial", "class", *[_round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query
def confusion_matrix(spark, sf_dir):
    return agreement.confusion_matrix(_labelled(spark, sf_dir), "y", "label", by=["trial"])


@query
def smoothed_cross_entropy(spark, sf_dir):
    loss = vectors.smoothed_cross_entropy(F.col("logits"), F.col("y"), 5, 0.3)
    per_batch = views.epoch_logits(spark, sf_dir).groupBy("epoch", "batch").agg(F.avg(loss).alias("loss"))
    return per_batch.groupBy("epoch").agg(_round(F.avg("loss")).alias("loss"))


@query
def argmax_class(spark, sf_dir):
    return views.epoch_logits(spark, sf_dir).select("epoch", "id", vectors.argmax(F.col("logits")).alias("p"))


@query
def ensemble_test(spark, sf_dir):
    means = thresholds.mean_thresholds(_swept_cuts(spark, sf_dir), ["trial"])
    return ensemble.cut_at(_combined(spark, sf_dir), means, ["trial"]).select("trial", "id", "label")


@query
def evaluate_run(spark, sf_dir):
    votes = ensemble.vote_mode(_labelled(spark, sf_dir), ["id"], carry=["y"])
    return agreement.evaluate(votes, "y", "label").select("metric", "class", _round("value", 9).alias("value"))


@query
def evaluate_stream(spark, sf_dir):
    """``evaluate_run`` of predictions that arrive a few trials at a time, the true classes with the
    last trial only, with a restart halfway."""
    rows = _labelled(spark, sf_dir).select("trial", "id", F.when(F.col("trial") == views.TRIALS - 1, F.col("y")).alias("y"), "label")
    made, checkpoint = fresh_path(spark, "streamed-votes"), fresh_path(spark, "stream-checkpoint")
    schema = voting.vote_stream(rows, ["id"]).schema
    _in_two_runs(spark, "arriving-predictions", rows, F.col("trial") < views.TRIALS // 2,
                 lambda stream: voting.write_votes(voting.vote_stream(stream, ["id"]), made, checkpoint))
    done = voting.evaluate_votes(spark, made, schema, ["id"])
    return done.select("metric", "class", _round("value", 9).alias("value"))


# --- composite jobs -----------------------------------------------------------------------------------

def _judged_evaluation(evaluation: DataFrame) -> DataFrame:
    """Supports as they are; whether every other value lies where its metric can."""
    support = F.when(F.col("metric") == "support", F.col("value"))
    return evaluation.select("metric", "class", support.alias("support"),
                             (support.isNotNull() | F.col("value").isNull() | (F.abs("value") <= 1)).alias("in_range"))


@query
def kfold_oof(spark, sf_dir):
    done = cut(training.kfold_oof(_order_matrix(spark, sf_dir), QUERY_SETTINGS).labels, "out-of-fold")
    kappa = agreement.qwk(done, "score", "label").first()["qwk"]
    return done.select("trial", "id", "fold", "score", F.col("label").between(0, 4).alias("labelled"),
                       F.lit(kappa is not None and kappa >= LEAST_KAPPA).alias("agrees"))


@query
def train_ensemble(spark, sf_dir):
    train, test = _holdout(spark, sf_dir)
    run = training.train_ensemble(train.drop("is_validation"), test.select("id", "features"), QUERY_SETTINGS)
    votes = cut(run.test_votes.join(test.select("id", "score"), "id"), "test-votes")
    on_test = agreement.qwk(votes, "score", "label").first()["qwk"]
    evaluation = cut(run.evaluation, "evaluation")
    enough = (F.col("metric") != "qwk") | (F.col("value") >= LEAST_KAPPA)
    return (_judged_evaluation(evaluation).join(evaluation.select("metric", "class", enough.alias("agrees")), ["metric", "class"])
            .withColumn("test_agrees", F.lit(on_test is not None and on_test >= LEAST_KAPPA)))


@query
def review_run(spark, sf_dir):
    result = whole.review_run(views.reviews(spark, sf_dir), QUERY_SETTINGS, _profile(spark, sf_dir), views.lexicon(spark))
    return _judged_evaluation(result.run.evaluation)


def _stand_in_detector():
    return lambda texts: ["fr" if text and len(text) % 2 else "en" for text in texts]


def _stand_in_scorer():
    import numpy as np

    def score(reviews, replies):
        marks = np.array([len(review or "") % 5 for review in reviews])
        return np.where(np.arange(5)[None, :] == marks[:, None], 0.6, 0.1)
    return score


@query
def review_run_plug_ins(spark, sf_dir):
    """The whole run with deterministic stand-ins for detector, translator and scorer."""
    models = whole.PlugIns(_stand_in_detector, lambda texts, language: [text.upper() for text in texts], _stand_in_scorer)
    result = whole.review_run(views.reviews(spark, sf_dir), QUERY_SETTINGS, plug_ins=models)
    return _judged_evaluation(result.run.evaluation)
