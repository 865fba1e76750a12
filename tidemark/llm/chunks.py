"""Substring deduplication by content-defined chunking.

A gear rolling hash over the bytes of a text cuts it after the word whose hash
is the smallest of some ``window`` words in a row, so boundaries move with the
content and an insertion changes only the chunks it touches.  Boundaries fall
after white space, so chunks are whole words.  No window is without a boundary:
two texts that share a passage cut it alike but for its first and last
``window`` words and the words that start in its first ``WINDOW`` bytes, at
most 7.  Of 50 words shared, 20 or more are therefore in whole shared chunks.
Long runs without white space (Chinese,
Japanese, Thai, encoded data, minified code) are cut between code points, and
``WORD_BYTES`` of their bytes count as a word.  Chunks are deduplicated by
digest: the document with the smallest key keeps a chunk, within a document its
first place.  A repeat is taken out only where consecutive repeated chunks hold
at least ``min_words`` words; shorter coincidences stay.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.common import staged

WINDOW = 16             # bytes the rolling hash looks back over
SEED = 20
WORD_BYTES = 6          # bytes of a long run that count as a word: two Han characters
LONG_RUN = 24           # more code points without white space are a long run, as are ...
UNSPACED = 4            # ... so many code points of scripts that put no spaces
_LOW = np.uint64(0xFFFFFFFF)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Cuts:
    """How texts are cut and which repeats count."""
    window: int = 11        # a boundary in every so many words ...
    longest: int = 1024     # ... and in every so many bytes
    min_words: int = 20
    span: int = 66          # a boundary in every so many bytes of a long run


DEFAULT = Cuts()

_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
CUT = StructType([StructField("text", StringType()), StructField("spans", ArrayType(_SPAN)),
                  StructField("owners", ArrayType(LongType()))])


def _gear() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 32, 256, np.uint32)


def _gear_hash(data: np.ndarray) -> np.ndarray:
    """Per byte, a hash of it and the ``WINDOW - 1`` bytes before it."""
    # The gear hash shifts once per byte: h = 2 h + gear[byte].  Sums over
    # WINDOW bytes are enough; they are made by doubling, over 2, 4, 8, 16 bytes.
    h, width = _gear()[data], 1
    while width < WINDOW:
        nxt = h.copy()
        nxt[width:] += h[:-width] << np.uint32(width)
        h, width = nxt, width * 2
    return h


def _between(marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many bytes of each ``[start, end)`` are marked."""
    seen = np.append(0, np.cumsum(marks))
    return seen[ends] - seen[starts]


def _long_runs(data: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space that are no single words."""
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    points = ends - starts
    if len(data) and data.max() >= 0x80:
        points = _between((data & 0xC0) != 0x80, starts, ends)
    long = points > LONG_RUN
    if len(data) and data.max() >= 0xE0:
        # Kana and Han (U+3000 to U+9FFF, U+20000 on), Thai and Lao, Burmese, Khmer.
        after = np.append(data[1:], 0)
        unspaced = ((data >= 0xE3) & (data <= 0xE9)) \
            | ((data == 0xF0) & (after >= 0xA0)) \
            | ((data == 0xE0) & (after >= 0xB8) & (after <= 0xBB)) \
            | ((data == 0xE1) & np.isin(after, (0x80, 0x81, 0x82, 0x9E, 0x9F)))
        long |= _between(unspaced, starts, ends) >= UNSPACED
    return starts[long], ends[long]


def _winnow(h: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """The places that have the smallest hash of some ``width`` consecutive
    places of one group, the last of equals."""
    n = len(h)
    if n < width:
        return np.empty(0, np.int64)
    m = (h.astype(np.uint64) << np.uint64(32)) | (_LOW - np.arange(n, dtype=np.uint64))
    w = 1
    while 2 * w <= width:
        m, w = np.minimum(m[:-w], m[w:]), 2 * w
    if w < width:
        m = np.minimum(m[:w - width], m[width - w:])
    m = m[group[:n - width + 1] == group[width - 1:]]
    at = (_LOW - (m & _LOW)).astype(np.int64)
    return at[np.append(True, at[1:] != at[:-1])] if len(at) else at


def _thinned(at: np.ndarray, h: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """``at`` with equals in a row as far apart as ``width`` allows: one
    character over and over is not cut at every place."""
    tied = (h[at[1:]] == h[at[:-1]]) & (group[at[1:]] == group[at[:-1]])
    if not tied.any():
        return at
    kept, places = [], at.tolist()
    for i, (p, before, after) in enumerate(zip(places, [False, *tied.tolist()],
                                               [*tied.tolist(), False])):
        if not (before and after and places[i + 1] - kept[-1] <= width):
            kept.append(p)
    return np.array(kept, np.int64)


def _in_runs(data, h, starts, ends, cuts) -> np.ndarray:
    """The boundaries of long runs: both edges, and code point starts inside."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts], edge[ends] = 1, -1
    places = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
    before = np.where((data[places] & 0xC0) != 0x80, h[places - 1], np.uint32(0xFFFFFFFF))
    lengths = ends - starts
    before[np.cumsum(lengths) - lengths] = 0xFFFFFFFF
    group = np.repeat(np.arange(len(starts)), lengths)
    inner = places[_thinned(_winnow(before, group, cuts.span), before, group, cuts.span)]
    inner = inner[(data[inner] & 0xC0) != 0x80]
    space = np.append(_SPACE[data], False)
    left = np.flatnonzero(~space)
    return np.union1d(np.union1d(inner, starts), left[np.searchsorted(left, ends)])


def boundaries(raw: bytes, cuts: Cuts = DEFAULT) -> list[int]:
    """End positions of the chunks of ``raw`` (UTF-8), the last is its length."""
    n = len(raw)
    if n == 0:
        return []
    data = np.frombuffer(raw, np.uint8)
    h = _gear_hash(data)
    space = _SPACE[data]
    last_space = space & ~np.append(space[1:], False)
    words = np.flatnonzero(last_space) + 1
    starts, stops = _long_runs(data, space)
    # No window of words reaches over the start of a long run.
    ends = words[_winnow(h[words - 1], np.searchsorted(starts, words), cuts.window)]
    if len(starts):
        ends = np.union1d(ends, _in_runs(data, h, starts, stops, cuts))
    out, at = [], 0
    for e in [*ends.tolist(), n]:
        if e - at > cuts.longest:
            at = _forced(data, last_space, h, at, e, cuts, out)
        if e > at:
            out.append(e)
            at = e
    return out


def _forced(data, last_space, h, at, end, cuts, out) -> int:
    """Cut ``[at, end)`` down to the longest chunk allowed: at the place whose
    hash is smallest among white space or, without any, code point starts."""
    while end - at > cuts.longest:
        lo, hi = at + cuts.longest // 2, at + cuts.longest
        places = np.flatnonzero(last_space[lo - 1:hi - 1]) + lo
        if not len(places):
            places = np.flatnonzero((data[lo:hi] & 0xC0) != 0x80) + lo
        at = int(places[np.argmin(h[places - 1])]) if len(places) else hi
        out.append(at)
    return at


def digests(raw: bytes, ends: list[int]) -> list[int]:
    """A 64-bit digest per chunk (signed).  The white space around a chunk is
    not part of it; a chunk shorter than the hash's window is taken together
    with the bytes before it that the window holds."""
    made, at = [], 0
    for e in ends:
        d = hashlib.blake2b(raw[min(at, max(0, e - WINDOW)):e].strip(), digest_size=8).digest()
        made.append(int.from_bytes(d, "little", signed=True))
        at = e
    return made


def _sizer(raw: bytes):
    """A function for the size of a chunk ``[at, end)``, in bytes of a long run:
    those it has, or ``WORD_BYTES`` for each word."""
    data = np.frombuffer(raw, np.uint8)
    starts, stops = (x.tolist() for x in _long_runs(data, _SPACE[data]))

    def size(at: int, end: int) -> int:
        i = bisect_right(starts, at) - 1
        if i >= 0 and at < stops[i]:
            return min(end, stops[i]) - at
        return len(raw[at:end].split()) * WORD_BYTES

    return size


def repeats(raw: bytes, foreign: set[int], cuts: Cuts = DEFAULT) -> list[tuple[int, int]]:
    """Byte spans of ``raw`` to take out: runs of chunks that are ``foreign`` or
    stood earlier in the text, with enough words in all."""
    ends = boundaries(raw, cuts)
    made = digests(raw, ends)
    size = None
    seen: set[int] = set()
    spans, run, held, at = [], None, 0, 0

    def close(end):
        if run is not None and held >= cuts.min_words * WORD_BYTES:
            spans.append((run, end))

    for e, d in zip(ends, made):
        if d in foreign or d in seen:
            size = size or _sizer(raw)
            if run is None:
                run, held = at, 0
            held += size(at, e)
        else:
            close(at)
            run = None
        seen.add(d)
        at = e
    close(at)
    return spans


def _key() -> Column:
    """The document a row belongs to: its id, or for a null id its text's hash,
    above all common ids."""
    own = F.pmod(F.xxhash64("text"), F.lit(1 << 61)) + F.lit(1 << 61)
    return F.coalesce(F.col("doc_id").cast("long"), own)


def chunk_digests(docs: DataFrame, cuts: Cuts = DEFAULT) -> DataFrame:
    """``(key, digest)`` once for each distinct chunk of each row."""

    def run(batches):
        for b in batches:
            keys = b.column(0).to_numpy()
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for at in range(0, len(texts), 500):
                found = [list(dict.fromkeys(digests(t, boundaries(t, cuts))))
                         for t in texts[at:at + 500]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(keys[at:at + 500], list(map(len, found)))),
                     pa.array([d for f in found for d in f], pa.int64())], ["key", "digest"])

    return docs.where("text is not null").select(_key().alias("key"), "text").mapInArrow(
        run, "key long, digest long")


def foreign_chunks(docs: DataFrame, cuts: Cuts = DEFAULT) -> DataFrame:
    """``(key, digest, owner)``: the chunks a document shares with one of a smaller key."""
    chunks = staged(chunk_digests(docs, cuts), "chunks")
    shared = chunks.groupBy("digest").agg(F.min("key").alias("owner"),
                                          F.max("key").alias("last")).where("owner < last")
    # The digest is hidden from the planner, so that a hot one can be split.
    owners = shared.select(F.col("digest").bitwiseXOR(F.lit(0).cast("long")).alias("digest"),
                           "owner")
    return chunks.join(owners, "digest").where("key > owner").select("key", "digest", "owner")


def deduplicate(docs: DataFrame, cuts: Cuts = DEFAULT) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc``, with ``text`` (repeats taken
    out), ``spans`` (``array<struct<start, end>>`` in code points of the old
    text) and ``owners`` (ids of the documents that keep what was taken out).

    Null texts stay null and empty ones empty.  Rows that share an id are one
    document, and what they share stays; a null id stands for its text and
    comes after all ids.  Ties are decided by the smallest id, then the first
    place in the text.  Other columns stay in ``doc`` and cannot clash; an
    empty table gives no rows."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                      _key().alias("key"), F.col("text").alias("old"))
    # A set: rows that share an id repeat its chunks, and all of them get the list.
    found = foreign_chunks(docs, cuts).groupBy("key").agg(F.collect_set(
        F.struct("digest", "owner")).alias("foreign"))
    joined = own.join(found, "key", "left")

    @F.arrow_udf(CUT)
    def cut(texts: pa.Array, foreign: pa.Array) -> pa.Array:
        rows = [_cut(t, f or (), cuts) for t, f in zip(
            texts.cast(pa.binary()).to_pylist(), foreign.to_pylist())]
        pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()),
             pa.array([[{"start": a, "end": b} for a, b in r[1]] for r in rows], pa.list_(pair)),
             pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["text", "spans", "owners"])

    return joined.select("doc", cut.asNondeterministic()("old", "foreign").alias("r")).select(
        "doc", "r.text", "r.spans", "r.owners")


def _cut(raw: bytes | None, foreign, cuts: Cuts):
    if raw is None:
        return None, [], []
    owner = {f["digest"]: f["owner"] for f in foreign}
    spans = repeats(raw, set(owner), cuts)
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    # The owners of the spans' chunks, where another document keeps them.
    ends = boundaries(raw, cuts) if spans else []
    starts = [0, *ends[:-1]]
    owners = {owner[d] for s, d in zip(starts, digests(raw, ends)) if d in owner
              and any(a <= s < b for a, b in spans)}
    places = [(len(raw[:a].decode()), len(raw[:b].decode())) for a, b in spans]
    return b"".join(kept).decode(), places, sorted(owners)


def without_repeats(docs: DataFrame, cuts: Cuts = DEFAULT) -> DataFrame:
    """``docs`` in its own columns with repeats taken out of the texts; a
    document of which no word is left goes.  ``n_chars``, where present,
    follows the new text."""
    done = deduplicate(docs, cuts)
    kept = done.where((F.size("spans") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text"),
           "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return kept.select(*[(new[c] if c in new else F.col(f"doc.`{c}`")).alias(c)
                         for c in docs.columns])
