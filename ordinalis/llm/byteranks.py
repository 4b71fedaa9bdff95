"""Encoding with a byte-level vocabulary file whose merges are in the order of their ids.

Such a file's tokens are ranks, so the rank encoder of tiktoken gives the ids that the
tokenizers library gives, several times as fast. Special strings inside texts become their
special ids, as that library does by default.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark import Broadcast

from ordinalis.llm.common import worker_state


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such files: itself if it prints, else one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteRanks:
    """``vocabulary`` is the file's JSON text, ``pattern`` what splits a text before the merges."""

    def __init__(self, vocabulary: str, pattern: str):
        import tiktoken

        file = json.loads(vocabulary)
        model, before = file["model"], file["pre_tokenizer"]
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if (model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or file["normalizer"]
                or file["post_processor"] or any(model["vocab"].get(m) != 256 + n for n, m in enumerate(merges))):
            raise ValueError("not a byte-level vocabulary with merges in the order of their ids")
        letters, special = _byte_letters(), {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        self._encoder = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str | None) -> np.ndarray:
        return self._encoder.encode_to_numpy(text or "", allowed_special="all")


def loaded(vocabulary: Broadcast, pattern: str) -> ByteRanks:
    """The tables, built once per Python worker."""
    return worker_state(("byte ranks", hash(vocabulary.value)), lambda: ByteRanks(vocabulary.value, pattern))
