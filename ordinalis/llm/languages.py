"""Language identification by interpolated Kneser-Ney models of letters.

One model per language over the letters of words (lower-cased, with a border before and
after). Spark counts the n-grams and their continuation counts from a bounded sample of
labelled texts; the finished models are sorted arrays of n-gram hashes with log
probabilities and back-off weights. A text goes to the language with the lowest cross-entropy
per letter. It is rejected when that entropy is nearer to what a model shows on texts of a
foreign language than to what it shows on its own; both levels come from held-out texts.

Words are scored once per worker and remembered in a bounded cache; a text is the sum over
its words, so whole texts of any length are judged in bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from ordinalis.llm.common import mix, small_batches, spare_names, worker_state
from ordinalis.storage import cut

ORDER = 4
#: Documented bound: about so many labelled texts per language are learned from, and a fifth
#: as many set the rejection border; they are drawn by a hash over all labelled rows.
SAMPLE_PER_LANGUAGE = 3000
UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]+")
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BORDER = "\x02"
#: Letters that the models haven't seen share this many places.
_UNSEEN_LETTERS = 1000


def letter_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters; none where no character is a letter."""
    words = _WORDS.findall(text.lower()) if text else []
    return words if any(map(str.isalpha, words)) or any(c.isalpha() for w in words for c in w) else []


def _hash_windows(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k code points that end at each place (codes is padded by ORDER - 1)."""
    n = len(codes) - ORDER + 1
    out = np.full(n, k, np.uint64)
    for i in range(ORDER - k, ORDER):
        out = mix(out * _GOLD + codes[i:n + i])
    return out


def _hash_gram(gram: str) -> int:
    codes = np.array([0] * (ORDER - len(gram)) + [ord(c) for c in gram], np.uint64)
    return int(_hash_windows(codes, len(gram))[0])


@dataclass
class LetterModel:
    """Per order sorted hashes of the seen n-grams with log probabilities, and of the seen
    contexts with log back-off weights."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]

    def log_probabilities(self, hashes: list[np.ndarray], context_hashes: list[np.ndarray]) -> np.ndarray:
        """For each place the interpolated log probability of its letter."""
        out = np.zeros(len(hashes[0]))
        open_places = np.arange(len(out))
        for order in range(ORDER, 0, -1):
            keys, values = self.grams[order - 1]
            wanted = hashes[order - 1][open_places]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found = keys[at] == wanted
            out[open_places[found]] += values[at[found]]
            open_places = open_places[~found]
            if len(open_places):
                keys, values = self.contexts[order - 1]
                wanted = context_hashes[order - 1][open_places]
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                out[open_places] += np.where(keys[at] == wanted, values[at], 0.0)
        out[open_places] -= np.log(_UNSEEN_LETTERS)
        return out


def _sorted_arrays(table: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.array([_hash_gram(g) for g in table], np.uint64)
    order = np.argsort(keys)
    return keys[order], np.log(np.array(list(table.values()))).astype(np.float32)[order]


def kneser_ney(counts: list[dict[str, int]]) -> LetterModel:
    """The model from the counts of each order (continuation counts below the highest)."""
    lower: dict[str, float] = {}
    grams, contexts = [], []
    for order, table in enumerate(counts, 1):
        values = list(table.values())
        once, twice = values.count(1), values.count(2)
        discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.1
        total: dict[str, int] = {}
        kinds: dict[str, int] = {}
        for gram, n in table.items():
            total[gram[:-1]] = total.get(gram[:-1], 0) + n
            kinds[gram[:-1]] = kinds.get(gram[:-1], 0) + 1
        weight = {context: discount * kinds[context] / total[context] for context in total}
        here = {gram: (n - discount) / total[gram[:-1]]
                + weight[gram[:-1]] * (lower[gram[1:]] if order > 1 else 1 / _UNSEEN_LETTERS)
                for gram, n in table.items()}
        grams.append(_sorted_arrays(here))
        contexts.append(_sorted_arrays(weight))
        lower = here
    return LetterModel(grams, contexts)


def gram_counts(texts: DataFrame, text_col: str, lang_col: str) -> list[DataFrame]:
    """(lang, gram, n) for each order up to ORDER: raw counts for the highest, and below it in how
    many different n-grams one letter longer a gram is the end."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = letter_words(text.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.string())],
                                                 names=["lang", "word"])

    seen = (texts.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("_text"))
            .mapInArrow(words, "lang string, word string").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    padded = F.concat(F.lit(_BORDER * (ORDER - 1)), "word", F.lit(_BORDER))
    place = F.explode(F.sequence(F.lit(1), F.length("word") + 1))
    highest = (seen.withColumn("_padded", padded).withColumn("_at", place)
               .groupBy("lang", F.expr(f"substring(_padded, _at, {ORDER})").alias("gram")).agg(F.sum("n").alias("n")))
    tables = [cut(highest, "letter-grams")]
    for _ in range(ORDER - 1):
        tables.insert(0, tables[0].groupBy("lang", F.expr("substring(gram, 2)").alias("gram"))
                      .agg(F.count(F.lit(1)).alias("n")))
    return tables


class Scorer:
    """Word and text scores against all models, with a bounded memory of words."""

    def __init__(self, languages: list[str], models: list[LetterModel], limit: int = 150_000):
        self.languages, self._models, self._limit = languages, models, limit
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self._known = np.zeros((0, len(self.languages)), np.float32)

    def _score_words(self, words: list[str]) -> np.ndarray:
        """Sums of log probabilities over the letters of each word and its end."""
        out = []
        for s in range(0, len(words), 4000):
            some = words[s:s + 4000]
            joined = "".join([_BORDER * (ORDER - 1) + w + _BORDER for w in some])
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
            hashes = [_hash_windows(codes, k) for k in range(1, ORDER + 1)]
            sizes = np.array([len(w) + 1 for w in some])
            first = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
            places = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            # a gram's context of k - 1 letters ends one place before the gram itself
            before = np.concatenate([np.zeros(1, np.uint64), codes[:-1]])
            contexts = [_hash_windows(before, k) for k in range(ORDER)]
            starts = np.cumsum(sizes) - sizes
            own, of = [h[places] for h in hashes], [h[places] for h in contexts]
            out.append(np.stack([np.add.reduceat(m.log_probabilities(own, of), starts) for m in self._models], axis=1))
        return np.concatenate(out).astype(np.float32)

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(letters of each text, sums of log probabilities per language)."""
        sums, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for t, text in enumerate(texts):
            words = letter_words(text)
            for s in range(0, len(words), 50_000):
                some = words[s:s + 50_000]
                if len(self._place) > self._limit:
                    self._forget()
                place = self._place
                new = [w for w in dict.fromkeys(some) if w not in place]
                if new:
                    start = len(place)
                    place.update(zip(new, range(start, start + len(new))))
                    if start + len(new) > len(self._known):
                        more = np.zeros((max(4096, len(self._known), len(new)), len(self.languages)), np.float32)
                        self._known = np.concatenate([self._known, more])
                    self._known[start:start + len(new)] = self._score_words(new)
                rows = np.fromiter(map(place.__getitem__, some), np.int64, len(some))
                sums[t] += self._known[rows].sum(axis=0, dtype=np.float64)
                sizes[t] += sum(map(len, some)) + len(some)
        return sizes, sums


def _scorer(models: Broadcast) -> Scorer:
    found = models.value
    return worker_state(("languages", found["key"]), lambda: Scorer(found["languages"], found["models"]))


def _entropies(text: Column | str, models: Broadcast) -> Column:
    """struct(letters, best language's place, its cross-entropy, the second best's, posterior)."""

    @F.arrow_udf("letters long, best int, entropy double, second double, score double")
    def of(texts: pa.Array) -> pa.Array:
        scorer, columns = _scorer(models), ([], [], [], [], [])
        for s in range(0, len(texts), 256):
            sizes, sums = scorer.score(texts.slice(s, 256).to_pylist())
            entropy = -sums / np.maximum(sizes, 1)[:, None]
            best = entropy.argmin(axis=1)
            ordered = np.sort(entropy, axis=1)
            lowest, second = ordered[:, 0], ordered[:, min(1, ordered.shape[1] - 1)]
            # posterior over a fixed number of letters, so that long texts don't all end at 1
            score = 1 / np.exp(-(entropy - lowest[:, None]) * np.minimum(sizes, 25)[:, None]).sum(axis=1)
            for column, values in zip(columns, (sizes, best, lowest, second, np.where(sizes > 0, score, 0.0))):
                column.append(values)
        types = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
        arrays = [pa.array(np.concatenate([*c, np.zeros(0)]), t, safe=False) for c, t in zip(columns, types)]
        return pa.StructArray.from_arrays(arrays, ["letters", "best", "entropy", "second", "score"])

    return of(text)


@dataclass
class LanguageModels:
    """Everything a prediction needs; a few MB, bounded by the sample."""

    broadcast: Broadcast | None
    languages: list[str]
    levels: list[tuple[float, float]]  # the border between own and foreign texts, and the scatter of one letter


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE, toward_foreign: float = 0.75) -> LanguageModels:
    """Learn from texts with a label; others, and texts without letters, take no part.

    About ``per_language`` texts of each language are learned from (a hash of the id decides,
    over all labelled rows) and a fifth as many set the border: ``toward_foreign`` of the way
    from their mean entropy to the mean of the second best model, which hasn't seen their language.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col).cast("string")).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModels(None, [], [])
    draw = (F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(1 << 30)) / float(1 << 30))
    share = F.lit(0.0)
    for language, n in sizes.items():
        share = F.when(F.col(lang_col).cast("string") == language, per_language * 1.2 / n).otherwise(share)
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit(8)), F.lit(6))
    sample = cut(rows.where(draw < share).select(F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_lang"),
                                                 part.alias("_part")), "language-sample")
    learned = sample if sample.count() < 6 * 20 else sample.where("_part > 0")
    counts = {language: [{} for _ in range(ORDER)] for language in languages}
    for order, table in enumerate(gram_counts(learned, "_text", "_lang")):
        found = table.toArrow()  # bounded by the sample
        for lang, gram, n in zip(*(found[c].to_pylist() for c in ("lang", "gram", "n"))):
            counts[lang][order][gram] = n
    languages = [language for language in languages if counts[language][0]]
    if not languages:
        return LanguageModels(None, [], [])
    models = [kneser_ney(counts[language]) for language in languages]
    shared = spark.sparkContext.broadcast({"key": hash((spark.sparkContext.applicationId, id(models), len(sizes))),
                                           "languages": languages, "models": models})
    held = sample.where("_part = 0") if learned is not sample else sample
    # written before it is filtered: a filter on what Python gives runs it twice, in two workers for each
    # core, and idle workers stay and take turns with the others in whatever runs later
    found = cut(held.select("_lang", _entropies("_text", shared).alias("_e")), "language-held-out")
    place = F.array_position(F.array(*map(F.lit, languages)), F.col("_lang")) - 1
    found = found.where("_e.letters > 0").select("_lang", "_e.*").where(place == F.col("best"))
    letter_noise = F.stddev_pop("entropy") * F.sqrt(F.avg(F.least("letters", F.lit(200))))
    rows_of = {r["_lang"]: r for r in found.groupBy("_lang").agg(
        F.avg("entropy").alias("own"), F.avg("second").alias("foreign"), letter_noise.alias("noise")).collect()}
    everywhere = [r["own"] for r in rows_of.values()] or [0.0]
    levels = []
    for language in languages:
        row = rows_of.get(language)
        own = row["own"] if row else sum(everywhere) / len(everywhere)
        foreign = row["foreign"] if row and row["foreign"] > own else 2 * own
        levels.append((own + toward_foreign * (foreign - own), row["noise"] if row else 0.0))
    return LanguageModels(shared, languages, levels)


def identify(docs: DataFrame, models: LanguageModels, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1), cross_entropy and rejected.

    A null text, or one without a letter, is ``und`` with score 0 and rejected; so is every
    text when there was nothing to learn from. Columns of these names are replaced; others may have
    any names; an empty table stays empty.
    """
    if models.broadcast is None:
        return (docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
                .withColumn("cross_entropy", F.lit(None).cast("double")).withColumn("rejected", F.lit(True)))
    small_batches(docs.sparkSession)
    e, = spare_names(docs, "_e")
    names = F.array(*map(F.lit, models.languages))
    border = F.array(*[F.lit(level) for level, _ in models.levels])
    noise = F.array(*[F.lit(scatter) for _, scatter in models.levels])
    place, letters = F.col(e)["best"] + 1, F.col(e)["letters"]
    # few letters scatter more around any level
    most = F.element_at(border, place) + 3 * F.element_at(noise, place) / F.sqrt(letters)
    known = letters > 0
    return (docs.withColumn(e, _entropies(text_col, models.broadcast))
            .withColumn("lang_pred", F.when(known, F.element_at(names, place)).otherwise(UNKNOWN))
            .withColumn("score", F.col(e)["score"]).withColumn("cross_entropy", F.when(known, F.col(e)["entropy"]))
            .withColumn("rejected", ~known | (F.col(e)["entropy"] > most)).drop(e))
