"""Small helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ordinalis.storage import cut

#: A word is a run of anything but the six white-space characters of ASCII.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_WORDS = re.compile(WORD_PATTERN)
#: White space that str.split knows besides those six.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class Recent(dict):
    """A bounded cache: two generations, the older one dropped when the younger is full.

    Looking up with ``[]`` computes what is missing. Long keys are computed each time and
    not kept, so ``limit`` entries have a bounded size.
    """

    def __init__(self, compute: Callable, limit: int = 150_000, longest: int = 64):
        super().__init__()
        self._compute, self._limit, self._longest, self._old = compute, limit, longest, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
            if isinstance(key, (str, bytes)) and len(key) > self._longest:
                return value
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


_STATE: dict = {}


def worker_state(name, build: Callable):
    """What an operator keeps in this Python worker between batches, made by ``build`` when first
    asked for. Workers serve one stage after another, so another operator's state goes first:
    no more than one bounded cache is held at a time."""
    if name not in _STATE:
        if _STATE:
            _STATE.clear()
            _give_back()
        _STATE[name] = build()
    return _STATE[name]


def _give_back() -> None:
    """Return freed memory to the machine, which the worker's allocators would keep for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def words_of(text: str | None) -> list[str]:
    """The words of ``WORD_PATTERN``: by str.split, unless the text holds white space that only it knows."""
    if not text:
        return []
    return _WORDS.findall(text) if _OTHER_SPACE.search(text) else text.split()


#: Odd constants (the golden ratio and two primes of a well-known mixer), fixed values.
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64 bits for each of the text's words, the same in every process; ``lower`` takes A-Z as a-z.

    Every byte and its place in the word give a random-looking number; a word's are summed.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    inside = ~_SPACES[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    lengths = edges[1::2] - edges[::2]
    if not len(lengths):
        return np.zeros(0, np.uint64)
    letters = (_LOWER[data] if lower else data)[inside].astype(np.uint64)
    first = np.cumsum(lengths) - lengths
    place = (np.arange(len(letters)) - np.repeat(first, lengths)).astype(np.uint64)
    numbers = mix(letters + (place << np.uint64(8)) + _GOLD)
    return mix(np.add.reduceat(numbers, first) + lengths.astype(np.uint64) * _GOLD)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of ``k`` consecutive word hashes; order counts."""
    if len(words) < k:
        return words[:0]
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out + _GOLD + words[i:n + i])
    return out


def with_column(df: DataFrame, of: str, name: str, kind: str, values: Callable[[pa.Array], pa.Array],
                rows: int = 256) -> DataFrame:
    """``df`` with column ``name`` computed from ``of`` by Python, ``rows`` at a time.

    Small steps matter where a value is many times as large as its text: no more than one
    step's values are held at once, whatever the size of Spark's Arrow batches.
    """
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c != name]
    schema = StructType([*df.select(*kept).schema, *StructType.fromDDL(f"`{name}` {kind}")])
    at = kept.index(of)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                some = batch.slice(start, rows)
                yield pa.RecordBatch.from_arrays([*some.columns, values(some.column(at))], names=schema.names)

    return df.select(*kept).mapInArrow(steps, schema)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let no more than ``rows`` rows go to a Python worker at a time, for this session: with whole
    texts in them, Spark's usual 10,000 take as much memory as all that an operator keeps."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, rows)


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores as it takes not to be a column of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut_small(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``cut`` for a table of at most ``rows`` rows: written by so few tasks that files are not tiny,
    however many shuffle partitions there are. The number of tasks grows with the rows."""
    return cut(df.coalesce(max(8, math.ceil(rows / 250_000))), name)


def size_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` (already written, so counting is cheap) is small enough to broadcast."""
    return df.count() <= rows
