"""SimHash near-duplicates over pigeonhole blocks.

A text's fingerprint has 64 bits, one majority vote per bit over the XXH64
values of its word shingles.  Two fingerprints that differ in at most ``k``
bits agree on at least two of ``k + 2`` blocks, so each distinct fingerprint
is keyed by every pair of its blocks; fingerprints that share a key are
compared, and those within the distance are linked.  Exact copies share one
fingerprint and are collapsed before any key is made.

A key shared by more than ``PAIR_LIMIT`` fingerprints is not expanded into
pairs.  There, every fingerprint lists itself with up to ``ceil(k/2)`` bits outside the key
flipped; two that differ in ``k`` or fewer bits meet in such a neighbour, and
each links only to the smallest fingerprint met there (the distance is
verified again).  For an even ``k`` every such link is within the distance,
and the work is linear in the group's size.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, unaligned
from tidemark.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
PAIR_LIMIT = 32
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_STEP = 1 << 16     # shingles whose bits are unpacked at once


def fingerprint(text: str | bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of one text; 0 where it has no word."""
    raw = text.encode() if isinstance(text, str) else (text or b"")
    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    elif shingle == 3:
        grams = [b"%b %b %b" % g for g in zip(words, words[1:], words[2:])]
    else:
        grams = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(grams), _STEP):
        part = grams[at:at + _STEP]
        h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in part), np.uint64, len(part))
        bits = np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row of ``docs``; ``fp`` is signed."""

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(fps.view(np.int64))],
                ["doc_id", "text_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text",
                       F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _block_masks(max_bits: int) -> list[int]:
    n = max_bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def _near(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)`` edges whose components are those of all links between the
    distinct fingerprints ``fp``.  Every edge is a true link."""
    if max_bits % 2 or max_bits < 0:
        raise ValueError("the exact way for crowded keys needs an even distance")
    masks = _block_masks(max_bits)
    keyed = distinct_fps.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("block", "key"))
    sizes = (keyed.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
             .select(F.col("block"), unaligned(F.col("key")).alias("key"), "n"))
    shared = staged(keyed.join(sizes, ["block", "key"]), "simhash-keys")
    few = shared.where(F.col("n") <= PAIR_LIMIT).select("block", "key", "fp")
    pairs = (few.join(few.withColumnRenamed("fp", "other"), ["block", "key"])
             .where((F.col("fp") < F.col("other")) & _near(F.col("fp"), F.col("other"), max_bits))
             .select(F.col("fp").alias("a"), F.col("other").alias("b")))
    crowded = shared.where(F.col("n") > PAIR_LIMIT)
    flips = F.array(*[F.array(*[F.lit(_signed(f)) for f in _flips(m, max_bits // 2)])
                      for m in masks])
    met = crowded.select("block", "fp", F.explode(F.transform(
        F.element_at(flips, F.col("block") + 1),
        lambda f: F.col("fp").bitwiseXOR(f))).alias("neighbour"))
    lowest = met.groupBy("block", "neighbour").agg(F.min("fp").alias("low")).select(
        "block", unaligned(F.col("neighbour")).alias("neighbour"), "low")
    stars = (met.join(lowest, ["block", "neighbour"])
             .where((F.col("fp") != F.col("low")) & _near(F.col("fp"), F.col("low"), max_bits))
             .select(F.col("fp").alias("a"), F.col("low").alias("b")))
    return pairs.unionByName(stars).distinct()


def _flips(mask: int, most: int) -> list[int]:
    free = [i for i in range(64) if not mask >> i & 1]
    return [sum(1 << i for i in c) for r in range(most + 1) for c in combinations(free, r)]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, text_hash, fp, group, component_id)``, one row per document.

    ``group`` is the component's smallest fingerprint (signed) and
    ``component_id`` its smallest ``doc_id``.  A null or wordless text has
    fingerprint zero and links like any other; null ids stay and are never
    the smallest unless a component has no other (then ``component_id`` is
    null); repeated rows come back as often as they came; an empty table
    gives no rows; further columns are ignored."""
    rows = staged(fingerprints(docs, shingle), "simhash-rows")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    labels = connected_components(links(fps.select("fp"), max_bits), "simhash-edges")
    grouped = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("label", "fp").alias("group"))
    lowest = grouped.groupBy("group").agg(F.min("low").alias("component_id")).select(
        unaligned(F.col("group")).alias("group"), "component_id")
    named = grouped.select("fp", "group").join(lowest, "group")
    return rows.join(named.select(unaligned(F.col("fp")).alias("fp"), "group", "component_id"),
                     "fp").select("doc_id", "text_hash", "fp", "group", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stand for their group: the smallest id (nulls
    last), then the smallest text hash; of rows equal in both one stays, the
    first by the JSON text of its other columns.  Those columns may have any
    name and type and come back as they were."""
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    keep = (near_duplicates(docs, shingle, max_bits).groupBy("group").agg(F.min(first).alias("k"))
            .select(F.xxhash64("k.doc_id").alias("key"), F.col("k.doc_id").alias("id"),
                    F.col("k.text_hash").alias("hash")))
    named = [F.col(f"`{c}`") for c in docs.columns]
    rest = [c for c, n in zip(named, docs.columns) if n not in ("doc_id", "text")]
    own = docs.select(
        F.struct(*named).alias("doc"), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("doc_id").cast("long")).alias("key"), F.xxhash64("text").alias("hash"),
        (F.to_json(F.struct(*rest)) if rest else F.lit("")).alias("others"))
    same = (own["key"] == keep["key"]) & (own["hash"] == keep["hash"]) \
        & own["id"].eqNullSafe(keep["id"])
    once = Window.partitionBy("key", "hash").orderBy("others")
    return (own.join(keep, same, "left_semi").withColumn("nth", F.row_number().over(once))
            .where("nth = 1").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns]))
