"""Two-text classifier: fit, score, cross-fit, and principal components of its scores."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, PCA, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from ordinalis.functions.text import fill_null
from ordinalis.functions.vectors import argmax, smoothed_cross_entropy
from ordinalis.operators.agreement import epoch_metrics
from ordinalis.operators.distinct import map_distinct
from ordinalis.operators.memo import Memo
from ordinalis.operators.ranks import batch_assign, holdout_split, kfold_assign
from ordinalis.schema import pca_names
from ordinalis.settings import Settings
from ordinalis.storage import cut


def text_stages(review: str, reply: str, settings: Settings) -> Pipeline:
    """Each text to a TF-IDF vector, and both vectors joined."""
    stages = []
    for side, column in (("review", review), ("reply", reply)):
        stages += [
            RegexTokenizer(inputCol=column, outputCol=f"_{side}_words", pattern=r"\p{L}+", gaps=False),
            HashingTF(inputCol=f"_{side}_words", outputCol=f"_{side}_tf", numFeatures=settings.hash_features),
            IDF(inputCol=f"_{side}_tf", outputCol=f"_{side}_vec"),
        ]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=["_review_vec", "_reply_vec"], outputCol="_pair")])


def _filled(df: DataFrame, *texts: str) -> DataFrame:
    return df.withColumns({c: fill_null(F.col(c)) for c in texts})


def fit_text_stages(rows: DataFrame, review: str, reply: str, settings: Settings) -> PipelineModel:
    """The document frequencies of both texts; ``rows`` have no missing texts."""
    return text_stages(review, reply, settings).fit(rows)


def fit_classifier(vectors: DataFrame, settings: Settings):
    """The classifier alone, on (_pair, score); every pass of the optimiser is a distributed sum.

    Label smoothing is exact: a row counts with s/K for every class and with 1 - s more for its
    own. The optimiser therefore keeps K weighted copies of each sparse vector in its cache
    (memory, then disk), which is what it needs room for.
    """
    classes, spread = range(settings.num_classes), settings.label_smoothing / settings.num_classes
    if settings.label_smoothing:
        own = F.when(F.col("score") == F.col("_k"), F.lit(1.0 - settings.label_smoothing)).otherwise(F.lit(0.0))
        vectors = (vectors.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in classes])))
                   .select("_pair", (own + F.lit(spread)).alias("_weight"), F.col("_k").alias("score")))
    else:
        vectors = vectors.withColumn("_weight", F.lit(1.0))
    # naming all classes keeps the score vector at full length when one does not occur
    named = {"ml_attr": {"type": "nominal", "name": "score", "vals": [str(k) for k in classes]}}
    regression = LogisticRegression(
        featuresCol="_pair", labelCol="score", weightCol="_weight", probabilityCol="_probability",
        rawPredictionCol="_logits", predictionCol="_class", family="multinomial",
        maxIter=settings.sentiment_iterations, regParam=settings.sentiment_reg)
    return regression.fit(vectors.select("_pair", "_weight", F.col("score").alias("score", metadata=named)))


def fit_sentiment_model(train: DataFrame, review: str, reply: str, settings: Settings) -> PipelineModel:
    """Fit text stages and classifier on the labelled rows.

    The text is read three times (two document frequencies, then the vectors); the optimiser
    keeps only the sparse vectors, so the raw text is never cached.
    """
    rows = _filled(train.where(F.col("score").isNotNull()), review, reply).select(review, reply, "score")
    texts = fit_text_stages(rows, review, reply, settings)
    return PipelineModel([*texts.stages, fit_classifier(texts.transform(rows).select("_pair", "score"), settings)])


def loss_history(model: PipelineModel) -> list[float]:
    """Training loss per iteration."""
    return list(model.stages[-1].summary.objectiveHistory)


def score_sentiment(df: DataFrame, model: PipelineModel, review: str, reply: str) -> DataFrame:
    """Adds ``probs`` ARRAY<DOUBLE> of the class scores."""
    scored = model.transform(_filled(df, review, reply))
    return scored.select(*df.columns, vector_to_array("_probability").alias("probs"))


@dataclass(frozen=True)
class SentimentTraining:
    model: PipelineModel
    train_metrics: DataFrame  # (epoch, loss, accuracy, qwk)
    validation_metrics: DataFrame | None  # None when all rows were trained on


def train_sentiment(train: DataFrame, id_col: str, review: str, reply: str, settings: Settings) -> SentimentTraining:
    """Fit with metrics along the way, on all rows or on all but a seeded holdout.

    An epoch is an equal share of the optimiser's iterations; it starts from the same point
    every time, so the shorter fits are the longer one's earlier states. The text stages are
    fitted once and the vectors written once; each epoch fits and judges the classifier only.
    """
    rows = train.where(F.col("score").isNotNull())
    if not settings.all_train:
        rows = holdout_split(rows, id_col, settings.holdout_share, settings.seed)
    else:
        rows = rows.withColumn("is_validation", F.lit(False))
    rows = _filled(rows.select(id_col, review, reply, "score", "is_validation"), review, reply)
    texts = fit_text_stages(rows.where(~F.col("is_validation")), review, reply, settings)
    vectors = cut(texts.transform(rows).select(id_col, "_pair", "score", "is_validation"), "text-vectors")
    fit_rows, held = vectors.where(~F.col("is_validation")), vectors.where("is_validation")
    judged = {"train": [], "validation": []}
    for epoch in range(1, settings.num_epochs + 1):
        steps = math.ceil(settings.sentiment_iterations * epoch / settings.num_epochs)
        classifier = fit_classifier(fit_rows.select("_pair", "score"), replace(settings, sentiment_iterations=steps))
        for part, table in (("train", fit_rows), ("validation", held)):
            if part == "train" or not settings.all_train:
                batched = batch_assign(table, id_col, settings.batch_size, settings.seed, epoch)
                judged[part].append(_judge(batched, classifier, settings, epoch))
    metrics = {part: cut(epoch_metrics(reduce(DataFrame.unionByName, tables), "score", "_p", "_loss", "batch",
                                       settings.num_classes), "epoch-metrics") if tables else None
               for part, tables in judged.items()}
    return SentimentTraining(PipelineModel([*texts.stages, classifier]), metrics["train"], metrics["validation"])


def _judge(vectors: DataFrame, classifier, settings: Settings, epoch: int) -> DataFrame:
    """(epoch, batch, score, _p, _loss) of one epoch's classifier."""
    scored = classifier.transform(vectors).withColumn("_scores", vector_to_array("_logits"))
    loss = smoothed_cross_entropy(F.col("_scores"), F.col("score"), settings.num_classes, settings.label_smoothing)
    return scored.select(F.lit(epoch).alias("epoch"), "batch", "score", argmax(F.col("_scores")).alias("_p"),
                         loss.alias("_loss"))


def score_with(df: DataFrame, review: str, reply: str, make_predict: Callable, batch_size: int = 256,
               memo: Memo | None = None) -> DataFrame:
    """``probs`` from a plugged-in model: ``make_predict()`` loads it once per Python worker
    and returns ``predict(reviews, replies) -> float array [n, K]``.

    Each distinct (review, reply) pair is scored once, in Arrow batches; with a ``memo`` once in
    all runs that share it.
    """
    predict = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    return map_distinct(_filled(df, review, reply), [review, reply],
                        lambda pairs: pairs.withColumn("probs", predict(review, reply)), memo)


def score_encoded(encoded: DataFrame, id_col: str, make_predict: Callable, max_length: int = 512,
                  batch_size: int = 64) -> DataFrame:
    """(id, probs) from a plugged-in model over ``encode_text_pair`` rows: ``make_predict()`` returns
    ``predict(review_ids, review_mask, reply_ids, reply_mask) -> float array [n, K]``, each
    argument an int array [n, max_length // 2]."""
    inputs = ("review_ids", "review_mask", "reply_ids", "reply_mask")
    predict = predict_batch_udf(make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size,
                                input_tensor_shapes=[[max_length // 2]] * len(inputs))
    return encoded.select(id_col, predict(*inputs).alias("probs"))


def cross_fit_scores(train: DataFrame, rest: DataFrame, id_col: str, review: str, reply: str,
                     settings: Settings) -> DataFrame:
    """Train rows scored by the model that did not see their fold, other rows by a full fit.

    The rows are written in one folder per fold, so scoring a fold reads only its own.
    """
    folded = cut(kfold_assign(train, id_col, settings.num_folds, settings.seed), "cross-fit", partition_by="fold")
    parts = []
    for fold in range(settings.num_folds):
        model = fit_sentiment_model(folded.where(F.col("fold") != fold), review, reply, settings)
        part = folded.where(F.col("fold") == fold).drop("fold")
        parts.append(score_sentiment(part, model, review, reply))
    full = fit_sentiment_model(folded, review, reply, settings)
    parts.append(score_sentiment(rest, full, review, reply))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@dataclass(frozen=True)
class ScorePca:
    """Means and signed loadings; applying them is plain column arithmetic."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    loadings: tuple[tuple[float, ...], ...]  # one tuple per component

    def apply(self, df: DataFrame) -> DataFrame:
        names = pca_names(len(self.loadings))
        centred = [F.col(f"`{c}`") - F.lit(m) for c, m in zip(self.columns, self.means)]
        return df.withColumns({name: reduce(add, [x * F.lit(w) for x, w in zip(centred, load)])
                               for name, load in zip(names, self.loadings)})


def fit_pca(df: DataFrame, columns: list[str], components: int) -> ScorePca:
    """Principal axes of the score columns; the largest loading of each axis is positive."""
    table = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    means = table.agg(*[F.avg(c) for c in table.columns]).first()
    vectors = table.select(array_to_vector(F.array(*[
        F.col(c) - F.lit(m) for c, m in zip(table.columns, means)])).alias("v"))
    axes = PCA(k=components, inputCol="v", outputCol="_pca").fit(vectors).pc.toArray()
    loadings = []
    for axis in axes.T:
        largest = max(axis, key=abs)
        loadings.append(tuple(float(w if largest > 0 else -w) for w in axis))
    return ScorePca(tuple(columns), tuple(float(m) for m in means), tuple(loadings))
