"""Byte-pair encoding with word ends: exact merges in linear time, and decoding.

``WordEndBpe`` never merges. An Aho-Corasick automaton finds the longest token at every place
of a piece; walking left to right, a token is kept if merging could have left it next to
the one before (the pair-compatibility table), else a shorter token of the same start is
tried, and if there is none the last token is taken back. Each place is given up at most
once, so the work is linear in the piece. ``RankedBpe`` gives the same ids by tiktoken's merges.

Texts are cut at white space first, as no piece of the split pattern crosses it; the ids
of a cut are cached. Null texts encode to no ids. Special strings inside texts become their
special ids, as the tokenizers library does by default. Decoding joins token strings with a
space, which is what the library does for a file without a decoder.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from ordinalis.llm.common import Recent, with_column, worker_state

#: White space of str.split that the split pattern of a vocabulary file doesn't know.
_SEPARATORS = "\x1c\x1d\x1e\x1f"

#: Cuts a worker remembers, in each of two generations; about 200 bytes each.
CACHED_CUTS = 200_000

_RANK = itemgetter(1)

#: A pair of tokens is looked up as one number.
_SIDE = 1 << 24

#: Stands for the end of a piece among its bytes.
_END = b"\xff"


class WordEndBpe:
    """The tables of one vocabulary file (its JSON text) and the two directions."""

    def __init__(self, vocabulary: str, cached_cuts: int = CACHED_CUTS):
        import regex

        file = json.loads(vocabulary)
        model = file["model"]
        self._refuse_others(file, model)
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        letters = self._byte_letters()
        # symbols 0..255 are bytes, 256..511 the same bytes at the end of a piece
        symbol = {letter: chr(byte) for byte, letter in enumerate(letters)}
        symbol |= {letter + suffix: chr(256 + byte) for byte, letter in enumerate(letters)}
        self._id, self._spelled, self._halves = [], [], []
        place = {}
        for name, spelled in symbol.items():
            self._add(place, name, vocab[name], spelled, None)
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self._add(place, left + right, vocab[left + right],
                      self._spelled[place[left]] + self._spelled[place[right]], (place[left], place[right]))
        self._prepare()

        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self._special = special
        self._at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        pattern = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self._spaces = regex.compile(r"\p{White_Space}+")

        top = max([*vocab.values(), *special.values()]) + 1
        names = [b""] * top
        for name, number in [*vocab.items(), *special.items()]:
            names[number] = name.encode() + b" "
        self._blob = np.frombuffer(b"".join(names), np.uint8)
        self._offsets = np.concatenate([[0], np.cumsum([len(n) for n in names])]).astype(np.int64)
        self._packed = [number.to_bytes(4, "little") for number in range(top)]

        self._piece_ids = Recent(self._encode_piece, 50_000)
        self._cut_ids = Recent(self._encode_cut, cached_cuts)
        self._cut_counts = Recent(self.count_cut, cached_cuts)
        self._cached_cuts = cached_cuts
        self.known_from = None  # the table that ``know_counts`` was last told

    @staticmethod
    def _refuse_others(file: dict, model: dict) -> None:
        steps = [n["type"] for n in (file["normalizer"] or {}).get("normalizers", [])]
        if (model["type"] != "BPE" or not model.get("end_of_word_suffix") or file["decoder"] is not None
                or steps != ["NFC", "Replace", "Lowercase"] or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError("not a lower-casing BPE vocabulary with word ends and without a decoder")

    @staticmethod
    def _byte_letters() -> list[str]:
        """The letter by which vocabulary files of this kind write each byte: printable bytes
        of Latin-1 are themselves, the others follow from code point 256 on."""
        printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = iter(range(256, 512))
        return [chr(b) if b in printable else chr(next(others)) for b in range(256)]

    def _add(self, place: dict, name: str, number: int, spelled: str, halves) -> None:
        place[name] = len(self._id)
        self._id.append(number)
        self._spelled.append(spelled)
        self._halves.append(halves)

    def _prepare(self) -> None:
        """What ``_encode_piece`` looks up."""
        import ahocorasick

        self._merged = {halves: rank for rank, halves in enumerate(self._halves) if halves}
        self._length = [len(s) for s in self._spelled]
        by_spelling = {s: rank for rank, s in enumerate(self._spelled)}
        self._automaton = ahocorasick.Automaton()
        for spelled, rank in by_spelling.items():
            self._automaton.add_word(spelled, rank)
        self._automaton.make_automaton()
        self._shorter = [self._longest_prefix(s, by_spelling) for s in self._spelled]
        self._compatible = Recent(self._check_pair, 100_000)

    @staticmethod
    def _longest_prefix(spelled: str, by_spelling: dict[str, int]) -> int:
        for end in range(len(spelled) - 1, 0, -1):
            if (rank := by_spelling.get(spelled[:end])) is not None:
                return rank
        return -1

    def _check_pair(self, pair: int) -> bool:
        """Whether merging leaves these two tokens side by side: taking back merges from the
        latest to the earliest, no two parts that meet at the border may have been merged
        before the part that hides them came to be."""
        left, right = divmod(pair, _SIDE)
        before = len(self._id) + 1
        while True:
            if self._merged.get((left, right), before) < before:
                return False
            if left > right:
                if self._halves[left] is None:
                    return True
                before, left = left, self._halves[left][1]
            else:
                if self._halves[right] is None:
                    if self._halves[left] is None:
                        return True
                    before, left = left, self._halves[left][1]
                else:
                    before, right = right + 1, self._halves[right][0]

    def _encode_piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        spelled = data[:-1].decode("latin-1") + chr(256 + data[-1])
        compatible, length, greedy = self._compatible, self._length, self._automaton.iter_long
        tail = [rank for _, rank in greedy(spelled)]  # the longest token at every step
        if all([compatible[a * _SIDE + b] for a, b in pairwise(tail)]):
            return b"".join([self._packed[self._id[t]] for t in tail])
        kept, at, dead, tail = [], 0, set(), iter(tail)
        token = next(tail)
        while True:
            end = at + length[token]
            if end not in dead and (not kept or compatible[kept[-1] * _SIDE + token]):
                kept.append(token)
                at = end
                if at == len(spelled):
                    return b"".join([self._packed[self._id[t]] for t in kept])
                if (token := next(tail, -1)) < 0:
                    tail = map(_RANK, greedy(spelled, at))
                    token = next(tail)
                continue
            tail = iter(())  # what followed the longest token doesn't follow another
            if (token := self._shorter[token]) < 0:
                dead.add(at)  # nothing fits here: whatever ends here is wrong
                token = kept.pop()
                at -= length[token]

    def _encode_cut(self, cut: str) -> bytes:
        if "<" in cut and self._at_special:
            parts = self._at_special.split(cut)
            if len(parts) > 1:
                return b"".join([self._packed[self._special[p]] if p in self._special else self._encode_cut(p) for p in parts])
        if cut.isascii():
            low = cut.lower()
        else:
            low = unicodedata.normalize("NFC", cut)
            # letter by letter where a capital sigma's small form would depend on its place
            low = low.lower() if "Σ" not in low else "".join(map(str.lower, low))
            if not unicodedata.is_normalized("NFC", low):
                return b"".join([self._piece_ids[piece] for piece in self._pieces.findall(low)])
        if low.isalpha():
            return self._encode_piece(low) if low == cut else self._cut_ids[low]
        word = low[:-1]
        if word.isalpha() and not low[-1].isalnum():  # a word and a sign: the word has its own place in the cache
            return self._cut_ids[word] + self._piece_ids[low[-1]]
        return b"".join([self._piece_ids[piece] for piece in self._pieces.findall(low)])

    def cuts(self, text: str | None) -> list[str]:
        """The text cut at white space."""
        if not text:
            return []
        if any([c in text for c in _SEPARATORS]):
            return [c for c in self._spaces.split(text) if c]
        return text.split()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit numbers."""
        return np.frombuffer(b"".join(map(self._cut_ids.__getitem__, self.cuts(text))), "<u4")

    def count(self, text: str | None) -> int:
        return sum(map(self._cut_counts.__getitem__, self.cuts(text)))

    def count_cut(self, cut: str) -> int:
        return len(self._encode_cut(cut)) // 4

    def know_counts(self, known: dict[str, int]) -> None:
        """Counts that are never forgotten, looked up before the cache of the others."""
        self._cut_counts = _Known(known, Recent(self.count_cut, self._cached_cuts))

    def decode(self, ids: np.ndarray, step: int = 1 << 18) -> str:
        """Token strings joined by a space, copied out of one blob by the offset table."""
        out = []
        for i in range(0, len(ids), step):
            first = self._offsets[ids[i:i + step]]
            size = self._offsets[ids[i:i + step] + 1] - first
            shift = first - (np.cumsum(size) - size)
            out.append(self._blob[np.repeat(shift, size) + np.arange(size.sum())].tobytes())
        return b"".join(out)[:-1].decode()


class RankedBpe(WordEndBpe):
    """The same ids by merging: the rank encoder of tiktoken merges the bytes of a piece.

    A byte that UTF-8 never uses marks the end of a piece. It is merged with the byte before it
    first, as those ranks are the lowest, and that makes the symbol at the end of a word. For cuts
    seen for the first time this takes a seventh of the walk's time.
    """

    def _prepare(self) -> None:
        import tiktoken

        ranks = {self._bytes(s): rank for rank, s in enumerate(self._spelled)}
        if len(ranks) < len(self._spelled):
            raise ValueError("two tokens are spelled alike")
        encoding = tiktoken.Encoding("vocabulary", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
        self._merge = encoding._core_bpe.encode_single_piece
        self._id_bytes = [number.to_bytes(4, "little") for number in self._id].__getitem__

    @staticmethod
    def _bytes(spelled: str) -> bytes:
        last = ord(spelled[-1])
        return spelled.encode("latin-1") if last < 256 else spelled[:-1].encode("latin-1") + bytes([last - 256]) + _END

    def _encode_piece(self, piece: str) -> bytes:
        return b"".join(map(self._id_bytes, self._merge(piece.encode("utf-8") + _END)))


class _Known(dict):
    def __init__(self, known: dict[str, int], rest: dict):
        super().__init__(known)
        self._rest = rest

    def __missing__(self, key):
        return self._rest[key]


def loaded(vocabulary: Broadcast, cached_cuts: int = CACHED_CUTS, kind: type[WordEndBpe] = WordEndBpe) -> WordEndBpe:
    """The tables, built once per Python worker."""
    name = (kind.__name__, hash(vocabulary.value), cached_cuts)
    return worker_state(name, lambda: kind(vocabulary.value, cached_cuts))


def share_vocabulary(spark: SparkSession, path: str, most_bytes: int = 64 << 20) -> Broadcast:
    """A vocabulary file, read by the driver and sent to the executors (its size is checked)."""
    with open(path, encoding="utf-8") as file:
        text = file.read(most_bytes + 1)
    if len(text) > most_bytes:
        raise ValueError(f"{path} has more than {most_bytes} characters")
    return spark.sparkContext.broadcast(text)


def encode(docs: DataFrame, vocabulary: Broadcast, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text (array<int>); null and empty texts have none.

    A column named ``ids_col`` is replaced. The other columns travel along, so select first.
    """

    def ids(texts: pa.Array) -> pa.Array:
        bpe = loaded(vocabulary)
        found = [bpe.encode(t.as_py()) for t in texts]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        flat = np.concatenate([*found, np.zeros(0, "<u4")]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return with_column(docs, text_col, ids_col, "array<int>", ids)


def decode(coded: DataFrame, vocabulary: Broadcast, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``coded`` with the text of each array of ids; null ids give a null text."""

    def texts(arrays: pa.Array) -> pa.Array:
        bpe, arrays = loaded(vocabulary), arrays.fill_null([])
        flat, ends = arrays.values.to_numpy(zero_copy_only=False), arrays.offsets.to_numpy()
        return pa.array([bpe.decode(flat[a:b].astype(np.int64)) for a, b in zip(ends[:-1], ends[1:])], pa.string())

    decoded = with_column(coded, ids_col, text_col, "string", texts)
    return decoded.withColumn(text_col, F.when(F.col(ids_col).isNotNull(), F.col(text_col)))
