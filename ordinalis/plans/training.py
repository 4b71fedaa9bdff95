"""Cross-validated ensemble over folds and seeds."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from ordinalis.operators.ensemble import cut_at, ensemble_weighted, oof_scatter, vote_mode
from ordinalis.operators.agreement import evaluate, qwk
from ordinalis.operators.boosting import columns_of, in_one_task
from ordinalis.operators.ranks import kfold_assign
from ordinalis.operators.refine import refine_thresholds
from ordinalis.operators.regressors import LEARNERS, Fitted, Learner, few_tasks, fit_learner, fit_tasks, for_fit
from ordinalis.operators.thresholds import mean_thresholds, optimize_thresholds
from ordinalis.settings import Settings
from ordinalis.sources.stages import described, fingerprint, keep, kept
from ordinalis.storage import cut, fresh_path

Learners = tuple[Learner, ...]


#: Tasks of overlapping fits per core: a fit is a chain of small jobs that leaves the cores idle between them.
OVERLAP = 2

#: Fits at a time that are each large enough for all cores: one's steps fill the gaps of another.
LARGE_AT_A_TIME = 4


def _at_a_time(spark, settings: Settings, rows: int, width: int | None = None) -> int:
    """Fits of ``rows`` rows (of ``width`` features) that keep all cores busy: many small ones, or a few large."""
    tasks = 1 if in_one_task(rows, width) else fit_tasks(spark, rows)
    room = OVERLAP * spark.sparkContext.defaultParallelism // tasks
    return settings.fit_threads or max(LARGE_AT_A_TIME, room)


def _each(spark, threads: int, jobs: list, run) -> None:
    """Several jobs overlap: each is a chain of distributed fits that leaves gaps between its steps."""
    with ThreadPool(threads) as pool:
        pool.map(inheritable_thread_target(spark)(lambda job: run(*job)), jobs, chunksize=1)


def _with_scores(df: DataFrame, fitted: list[Fitted], keep: list[str]) -> DataFrame:
    """keep..., one column per learner, and the rounds that each of them kept."""
    for one in fitted:
        df = one.score(df)
    rounds = F.create_map(*[F.lit(x) for one in fitted for x in (one.name, one.rounds or 0)])
    return df.select(*keep, *[one.name for one in fitted], rounds.alias("rounds"))


def _write_scores(df: DataFrame, fitted: list[Fitted], keep: list[str], path: str, **constants: int) -> None:
    made = _with_scores(df, fitted, keep)
    made.withColumns({name: F.lit(value) for name, value in constants.items()}).write.parquet(path)


def _scores(spark, folders: list[str], keys: str, learners: Learners) -> DataFrame:
    columns = "".join(f", `{learner.name}` double" for learner in learners)
    return spark.read.schema(f"{keys}{columns}, rounds map<string, int>").parquet(*folders)


class _Gathered:
    """Fits of several learners that end in any order; the last of a set hands them all over."""

    def __init__(self, learners: Learners):
        self._order, self._sets, self._lock = [learner.name for learner in learners], {}, Lock()

    def add(self, key, fitted: Fitted) -> list[Fitted] | None:
        with self._lock:
            found = self._sets.setdefault(key, {})
            found[fitted.name] = fitted
            if len(found) < len(self._order):
                return None
            del self._sets[key]
            return [found[name] for name in self._order]


def _learner_parts(learner: Learner, seed: int, settings: Settings) -> dict:
    """What tells one learner's fit from another's: its estimator with all parameters."""
    estimator = learner.build(seed, settings)
    values = {p.name: v for p, v in estimator.extractParamMap().items()}
    return {"name": learner.name, "stop_on": learner.stop_on, "class": type(estimator).__name__, "parameters": values}


def oof_predictions(folded: DataFrame, settings: Settings, seeds: dict[int, int],
                    learners: Learners = LEARNERS, path: str | None = None) -> DataFrame:
    """(trial, fold, id, score, one column per learner, rounds) for every row and trial.

    ``folded`` has (id, score, features, fold). Folds are the same in every trial; only the
    learners' seeds change. The models of one fold and trial score their rows, which are
    written, and are dropped; as many fits run at a time as keep the cores busy, or ``fit_threads``.

    With ``path`` each fold of a trial is a kept stage, named by the rows, folds, learners, seed and
    stopping rule it came from: a run that is started again fits only what isn't there
    yet, one with other folds, seeds, learners or rows fits its own, and neither reads the other's.
    """
    spark = folded.sparkSession
    scratch = fresh_path(spark, "oof-predictions")
    rows = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(rows.values())
    common = {} if path is None else {"matrix": fingerprint(folded), "folds": settings.num_folds,
                                      "patience": settings.patience, "round_block": settings.round_block}

    def made_from(fold: int, trial: int) -> dict:
        return described(common | {"fold": fold, "trial": trial,
                                   "learners": [_learner_parts(one, seeds[trial], settings) for one in learners]})

    places = [(fold, trial) for fold in range(settings.num_folds) for trial in seeds]
    parts = {place: made_from(*place) for place in places} if path else {}
    folders = {place: kept(spark, path, parts[place]) if path else None for place in places}
    gathered = _Gathered(learners)

    def run(fold: int, trial: int, learner: Learner) -> None:
        inside, outside = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        held = rows.get(fold, 0)
        outside = few_tasks(outside, held)
        one = fit_learner(learner, for_fit(inside, total - held), seeds[trial], settings, outside)
        fitted = gathered.add((fold, trial), one)
        if fitted:
            write = lambda folder: _write_scores(outside, fitted, ["id", "score"], folder, trial=trial, fold=fold)
            if path:
                folders[fold, trial] = keep(spark, path, parts[fold, trial], write)
            else:
                folders[fold, trial] = f"{scratch}/{fold}-{trial}"
                write(folders[fold, trial])

    threads = _at_a_time(spark, settings, total - min(rows.values(), default=0), columns_of(folded, "features"))
    _each(spark, threads, [(*place, learner) for place in places if folders[place] is None for learner in learners], run)
    score = folded.schema["score"].dataType.simpleString()
    keys = f"id {folded.schema['id'].dataType.simpleString()}, score {score}, trial int, fold int"
    return _scores(spark, list(folders.values()), keys, learners)


def _folded(train: DataFrame, settings: Settings) -> DataFrame:
    """The matrix, written once in one folder per fold: a validation pass reads only its own."""
    return cut(kfold_assign(train, "id", settings.num_folds, settings.seed), "folds", partition_by="fold")


@dataclass(frozen=True)
class CrossValidated:
    labels: DataFrame  # (trial, id, fold, score, label), out of fold
    cuts: DataFrame  # (trial, fold, t1..t4, qwk)
    means: DataFrame  # (trial, t1..t4)
    mean_cut: DataFrame  # (trial, qwk) out of fold, cut at the mean thresholds instead of the fold's own


def cross_validate(predictions: DataFrame, settings: Settings) -> CrossValidated:
    """Ensemble, search thresholds per trial and fold, cut, and average the thresholds."""
    combined = ensemble_weighted(predictions, settings.weights)
    by = ["trial", "fold"]
    start = settings.start_thresholds()
    search = refine_thresholds if settings.full_thresholds else optimize_thresholds
    cuts = cut(search(combined, "score", "prediction", by, start), "fold-thresholds")
    labels = cut_at(combined, cuts, by, count=len(start)).select("trial", "id", "fold", "score", "label")
    means = mean_thresholds(cuts, ["trial"], len(start))
    mean_cut = qwk(cut_at(combined, means, ["trial"], count=len(start)), "score", "label", ["trial"])
    return CrossValidated(oof_scatter(labels), cuts, means, mean_cut)


def kfold_oof(train: DataFrame, settings: Settings, trial: int = 0,
              learners: Learners = LEARNERS, path: str | None = None) -> CrossValidated:
    """One trial over all folds; ``train`` has (id, score, features)."""
    folded = _folded(train, settings)
    seeds = {trial: settings.trial_seeds()[trial]}
    return cross_validate(oof_predictions(folded, settings, seeds, learners, path), settings)


@dataclass(frozen=True)
class EnsembleRun:
    validated: CrossValidated
    votes: DataFrame  # (id, score, label): out-of-fold labels voted over the trials
    test_votes: DataFrame  # (id, label)
    evaluation: DataFrame  # (metric, class, value)


def refit_predictions(train: DataFrame, test: DataFrame, settings: Settings, seeds: dict[int, int],
                      learners: Learners = LEARNERS, validated: DataFrame | None = None) -> DataFrame:
    """(trial, id, one column per learner, rounds): models refitted on all train rows.

    They run all rounds, or with ``refit_rounds="mean_best"`` the mean of those the trial's
    folds kept, read from ``validated``, the out-of-fold predictions.
    """
    spark = train.sparkSession
    path = fresh_path(spark, "test-predictions")
    best: dict[int, dict[str, int]] = {}
    if settings.refit_rounds == "mean_best" and validated is not None:
        kept_rounds = validated.select("trial", "fold", F.explode("rounds").alias("name", "n")).distinct()
        for row in kept_rounds.groupBy("trial", "name").agg(F.round(F.avg("n")).cast("int").alias("n")).collect():
            best.setdefault(row["trial"], {})[row["name"]] = max(1, row["n"])
    rows = train.count()
    train = for_fit(train, rows)
    gathered = _Gathered(learners)

    def run(trial: int, learner: Learner) -> None:
        rounds = best.get(trial, {}).get(learner.name)
        fitted = gathered.add(trial, fit_learner(learner, train, seeds[trial], settings, rounds=rounds))
        if fitted:
            _write_scores(test, fitted, ["id"], f"{path}/{trial}", trial=trial)

    threads = _at_a_time(spark, settings, rows, columns_of(train, "features"))
    _each(spark, threads, [(trial, learner) for trial in seeds for learner in learners], run)
    keys = f"id {train.schema['id'].dataType.simpleString()}, trial int"
    return _scores(spark, [f"{path}/{trial}" for trial in seeds], keys, learners)


def ensemble_test(predictions: DataFrame, means: DataFrame, settings: Settings) -> DataFrame:
    """(trial, id, label): weighted predictions cut at their trial's mean thresholds."""
    combined = ensemble_weighted(predictions, settings.weights)
    return cut_at(combined, means, ["trial"], count=settings.num_classes - 1).select("trial", "id", "label")


def train_ensemble(train: DataFrame, test: DataFrame, settings: Settings,
                   learners: Learners = LEARNERS, path: str | None = None) -> EnsembleRun:
    """All trials: out-of-fold labels, test labels, votes and the final evaluation.

    ``train`` has (id, score, features) and is written once, because every fit reads it;
    ``test`` (id, features) is read once a trial. ``path`` keeps the out-of-fold predictions, each
    under what it was made from.
    """
    seeds = dict(enumerate(settings.trial_seeds()))
    folded = _folded(train, settings)
    predictions = oof_predictions(folded, settings, seeds, learners, path)
    validated = cross_validate(predictions, settings)
    test_rows = refit_predictions(folded.drop("fold"), test, settings, seeds, learners, predictions)
    votes = vote_mode(validated.labels, ["id"], num_classes=settings.num_classes, carry=["score"])
    test_votes = vote_mode(ensemble_test(test_rows, validated.means, settings), ["id"],
                           num_classes=settings.num_classes)
    return EnsembleRun(validated, votes, test_votes, evaluate(votes, "score", "label", settings.num_classes))
