"""BPE encoding and decoding with a segment tree over pair ranks.

Text is split as the vocabulary's pre-tokenizer does.  Within a piece, the
leaves of a segment tree hold ``rank * n + position`` of each adjacent pair;
the root is then the leftmost pair of the lowest rank.  A merge changes three
leaves, each in logarithmic time, until the root holds no mergeable pair.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from tidemark.llm.vocabulary import PATTERN, Vocabulary, load

CACHE_PIECES = 600_000      # per Python worker
CACHE_PIECE_CHARS = 32      # longer pieces are not kept


def merge(ids: list[int], vocabulary: Vocabulary) -> list[int]:
    """The ids of one piece after all merges; ``ids`` are its bytes' ids."""
    n = len(ids)
    if n < 2:
        return ids
    rank, made = vocabulary.rank, vocabulary.made
    none = len(made) * n
    size = 1 << (n - 2).bit_length()
    tree = [none] * (2 * size)
    find = rank.get
    for i in range(n - 1):
        r = find(ids[i] << 32 | ids[i + 1])
        if r is not None:
            tree[size + i] = r * n + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def put(i, value):
        i += size
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            value = a if a < b else b
            if tree[i] == value:
                break
            tree[i] = value
            i >>= 1

    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (best := tree[1]) < none:
        r, i = divmod(best, n)
        j = after[i]
        k = after[j]
        ids[i], after[i] = made[r], k
        if j < n - 1:
            put(j, none)
        if k < n:
            before[k] = i
            r = find(ids[i] << 32 | ids[k])
            put(i, none if r is None else r * n + i)
        else:
            put(i, none)
        h = before[i]
        if h >= 0:
            r = find(ids[h] << 32 | ids[i])
            put(h, none if r is None else r * n + h)
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


class _Pieces(dict):
    """Packed ids by piece.  A full cache admits no more, as common pieces are
    met early; after as many misses as it has entries it starts anew, so it
    follows a change of language."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.misses = vocabulary, 0

    def __missing__(self, piece: str) -> bytes:
        base = self.vocabulary.base
        packed = np.array(merge([base[b] for b in piece.encode()], self.vocabulary),
                          np.int32).tobytes()
        if len(piece) <= CACHE_PIECE_CHARS:
            if len(self) < CACHE_PIECES:
                self[piece] = packed
            else:
                self.misses += 1
                if self.misses >= CACHE_PIECES:
                    self.clear()
                    self.misses = 0
        return packed


def _newer_letters() -> re.Pattern:
    """Code points that the splitting library may class as letters or digits
    although older character tables do not know them yet."""
    known = regex.compile(r"[\p{L}\p{N}]")
    codes = [c for c in range(0x80, 0x110000)
             if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    starts = [c for k, c in enumerate(codes) if not k or codes[k - 1] != c - 1]
    ends = [c for k, c in enumerate(codes) if k + 1 == len(codes) or codes[k + 1] != c + 1]
    ranges = "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))
    return re.compile(f"[{ranges}]") if codes else re.compile(r"(?!)")


def _latin_pattern() -> re.Pattern:
    """``PATTERN`` with its classes written out for texts of Latin-1 characters,
    for which the standard library's engine is faster."""
    def members(kind):
        found = regex.compile(kind)
        return "".join(re.escape(chr(c)) for c in range(256) if found.match(chr(c)))

    letters, digits, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(
        PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{digits}]")
        .replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]")
        .replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]"))


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = _Pieces(vocabulary)
        self.special = vocabulary.split_special
        self.split, self.split_latin = regex.compile(PATTERN).findall, _latin_pattern().findall
        self.beyond_latin = re.compile("[\u0100-\U0010ffff]")
        self.high = re.compile("[\u0500-\U0010ffff]")     # no newer letter lies below
        self.odd = _newer_letters()
        self.library = vocabulary.tokenizer().pre_tokenizer
        known = [vocabulary.bytes_of.get(i, b"") for i in range(max(vocabulary.bytes_of) + 1)]
        self.length = np.array(list(map(len, known)), np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(known), np.uint8)

    def _ordinary(self, text: str) -> bytes:
        if not self.beyond_latin.search(text):
            parts = self.split_latin(text)
        elif self.high.search(text) and self.odd.search(text):
            # Split by the vocabulary's own library, whose tables decide.
            parts = [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        else:
            parts = self.split(text)
        return b"".join(map(self.pieces.__getitem__, parts))

    def encode(self, text: str) -> np.ndarray:
        if self.special is None or not self.special.search(text):
            return np.frombuffer(self._ordinary(text), np.int32)
        special = self.vocabulary.special
        return np.frombuffer(b"".join(
            np.array([special[part]], np.int32).tobytes() if k % 2 else self._ordinary(part)
            for k, part in enumerate(self.special.split(text))), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: their bytes gathered from one table of all tokens."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or (length := self.length[ids]).min() < 1):
            raise ValueError("an id that the vocabulary does not have")
        if not len(ids):
            return ""
        ends = np.cumsum(length)
        at = np.arange(ends[-1]) + np.repeat(self.start[ids] - (ends - length), length)
        return self.bytes[at].tobytes().decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def _codec(data: bytes) -> Codec:
    return Codec(load(data))


def encode(text: Column | str, vocabulary: Broadcast) -> Column:
    """``array<int>`` of the text's ids; special tokens' strings give their ids.
    A null text is the empty text and has no ids."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def run(texts: pa.Array) -> pa.Array:
        codec = _codec(vocabulary.value)
        rows = [codec.encode(t or "") for t in texts.to_pylist()]
        ends = np.zeros(len(rows) + 1, np.int32)
        np.cumsum([len(r) for r in rows], out=ends[1:])
        flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return run.asNondeterministic()(text)


def decode(ids: Column | str, vocabulary: Broadcast) -> Column:
    """The text of ``array<int>`` ids, special tokens included; bytes that are
    no UTF-8 become U+FFFD, null ids no text, an unknown id ends the job."""

    @F.arrow_udf(StringType())
    def run(rows: pa.Array) -> pa.Array:
        codec = _codec(vocabulary.value)
        flat = rows.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return pa.array([codec.decode(flat[a:b]) if ok else None for a, b, ok in zip(
            starts, ends, rows.is_valid().to_pylist())], pa.string())

    return run.asNondeterministic()(ids)
