"""A byte-level BPE vocabulary from the JSON file of a public tokenizer.

The driver reads the file (its path is a parameter) and broadcasts the bytes,
so executors need no copy of it; ``MAX_VOCABULARY_BYTES`` bounds the broadcast.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex
import tiktoken
import tokenizers
from pyspark import Broadcast
from pyspark.sql import SparkSession

MAX_VOCABULARY_BYTES = 64 << 20

# Fixed value: the pattern that byte-level BPE splits text with before merging.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def broadcast_vocabulary(spark: SparkSession, path: str | None = None) -> Broadcast:
    with open(path or default_path(), "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file exceeds {MAX_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte: itself where Latin-1
    prints it, else the next free one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in printable}
    out.update({chr(0x100 + i): b for i, b in
                enumerate(sorted(set(range(256)) - set(printable)))})
    return out


class Vocabulary:
    """Token bytes by id, merge ranks by pair of ids, special tokens."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or spec.get("normalizer")
                or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or model.get("ignore_merges")
                or model.get("dropout")):
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters = _byte_letters()
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word")
               for t in spec.get("added_tokens", [])):
            raise ValueError("special tokens that strip their surroundings")
        self.bytes_of = {i: bytes(letters[c] for c in s) for s, i in ids.items()
                         if all(c in letters for c in s)}
        self.bytes_of.update({i: s.encode() for s, i in self.special.items()})
        self.base = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = [ids[a + b] for a, b in merges]
        self.rank = {ids[a] << 32 | ids[b]: r for r, (a, b) in enumerate(merges)}
        self.data = data
        self._library = None

    @property
    def split_special(self):
        return regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None

    def tokenizer(self) -> tokenizers.Tokenizer:
        t = tokenizers.Tokenizer.from_str(self.data.decode())
        t.no_truncation()
        t.no_padding()
        return t

    def encoder(self):
        """``text -> array of ids``, equal to the tokenizers library's ids.

        Where ids follow the order of the merges (so that ranks can be read
        off the ids), the ids come from the faster tiktoken."""
        if self.made == sorted(self.made) and max(self.base) < self.made[0]:
            ranks = {b: i for i, b in self.bytes_of.items() if i not in self.special.values()}
            fast = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks,
                                     special_tokens=self.special)
            allowed = set(self.special)

            def encode(text: str) -> np.ndarray:
                try:
                    return fast.encode_to_numpy(text, allowed_special=allowed)
                except ValueError:      # a run of blanks beyond its splitter's stack
                    return self._slow_ids(text)
            return encode
        return self._slow_ids

    def _slow_ids(self, text: str) -> np.ndarray:
        if self._library is None:
            self._library = self.tokenizer()
        return np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def load(data: bytes) -> Vocabulary:
    """One vocabulary per Python worker, however many tasks it runs."""
    return Vocabulary(data)


@lru_cache(maxsize=2)
def load_encoder(data: bytes):
    return load(data).encoder()
