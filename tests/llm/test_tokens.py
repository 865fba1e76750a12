from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOC_SCHEMA, doc, sentence_text
from tidemark.llm import bpe, packing
from tidemark.llm.vocabulary import Vocabulary, broadcast_vocabulary, default_path

PARTS = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "　", "'s", "'S", "'ll",
         "<|endoftext|>", "<|endof", "a", "Z", "é", "ß", "1", "²", "Ⅷ", "👍🏽", "‍", "漢", "字",
         "ा", "!!", "--", "\x00", "﻿", "İ", "՘", "࢏", "\U000107bb", "hello", "tion"]


@pytest.fixture(scope="module")
def vocabulary():
    with open(default_path(), "rb") as f:
        return Vocabulary(f.read())


def test_ids_and_texts_equal_the_library(vocabulary):
    codec, library, fast = bpe.Codec(vocabulary), vocabulary.tokenizer(), vocabulary.encoder()
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 16))) for _ in range(6000)]
    texts += ["a" * 5000, " " * 3000, "é" * 2000, "\n" * 999, sentence_text(1, 900)]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert codec.encode(t).tolist() == ids, repr(t)
        assert fast(t).tolist() == ids, repr(t)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    half = library.encode("漢", add_special_tokens=False).ids[:1]
    assert codec.decode(half) == library.decode(half, skip_special_tokens=False)


def test_piece_cache_starts_anew(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    codec, library = bpe.Codec(vocabulary), vocabulary.tokenizer()
    for s in range(20):
        t = sentence_text(s)
        assert codec.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids
        assert len(codec.pieces) <= 5


def test_round_trip_of_odd_rows(spark, odd_docs, no_docs, vocabulary):
    shared, library = broadcast_vocabulary(spark), vocabulary.tokenizer()
    for docs in (odd_docs, no_docs):
        rows = docs.select("text", bpe.encode("text", shared).alias("i")).select(
            "*", bpe.decode("i", shared).alias("back")).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.i == library.encode(r.text or "", add_special_tokens=False).ids
            assert r.back == (r.text or "")
    null = spark.range(1).select(F.lit(None).cast("array<int>").alias("i"))
    assert null.select(bpe.decode("i", shared).alias("t")).first().t is None


def test_differencing_is_near_even():
    r = random.Random(1)
    for n, k in ((1, 1), (0, 3), (5, 9), (40, 7), (400, 50)):
        sizes = [r.randint(1, 256) for _ in range(n)]
        load = np.bincount(packing.differencing(sizes, k), sizes, k) if n else np.zeros(k)
        assert load.sum() == sum(sizes)
        if n > 4 * k:
            assert load.max() - load.min() <= 40
    assert sorted(np.bincount(packing.differencing([8, 7, 6, 5, 4], 2), [8, 7, 6, 5, 4])) \
        in ([14, 16], [15, 15])
    sizes = [700, 700, 700]             # two windows cannot hold them: the count rises
    assert len(set(packing.fit(sizes, 1024).tolist())) == 3


def check_pieces(rows, ids_of, capacity):
    """ids_of: list of (doc_id, ids); repeated documents are told apart by count."""
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    whole = defaultdict(list)
    for d, ids in ids_of:
        whole[d].append(ids)
    assert set(whole) == set(pieces)
    for d, texts in whole.items():
        want = sorted((r.start, bytes(r.ids)) for r in pieces[d])
        assert sum(len(i) for i in texts) == sum(r.length for r in pieces[d])
        assert {r.doc_tokens for r in pieces[d]} == {len(i) for i in texts}
        if len(texts) == 1:
            at = 0
            for start, raw in want:
                assert start == at and raw == np.array(texts[0][at:at + len(raw) // 4],
                                                       "<u4").tobytes()
                at += len(raw) // 4
    return len(windows)


def test_pieces_of_odd_rows(spark, odd_docs, no_docs, vocabulary):
    shared, library = broadcast_vocabulary(spark), vocabulary.tokenizer()
    ids = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [0])
           for r in odd_docs.collect()]
    for capacity in (1024, 7, 1):
        few = [x for x in ids if len(x[1]) < 5000] if capacity == 1 else ids
        docs = odd_docs.where("length(text) < 5000 or text is null") if capacity == 1 else odd_docs
        few = few if capacity > 1 else [
            (r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [0])
            for r in docs.collect()]
        rows = packing.pack(docs, shared, capacity).collect()
        check_pieces(rows, few, capacity)
    assert packing.pack(no_docs, shared).count() == 0


def test_little_padding_and_crc(spark, vocabulary):
    docs = spark.createDataFrame([doc(i, sentence_text(i, 9 * (1 + i * 7 % 60)))
                                  for i in range(400)], DOC_SCHEMA).coalesce(1)
    shared, library = broadcast_vocabulary(spark), vocabulary.tokenizer()
    ids = [(r.doc_id, library.encode(r.text, add_special_tokens=False).ids + [0])
           for r in docs.collect()]
    pieces = packing.pack(docs, shared).withColumn("crc", F.crc32("ids"))
    rows = pieces.collect()
    windows = check_pieces(rows, ids, 1024)
    assert sum(len(i) for _, i in ids) >= 0.99 * 1024 * windows
    assert all(r.crc == zlib.crc32(bytes(r.ids)) for r in rows)


def test_packing_of_a_long_run_of_blanks(spark, vocabulary):
    texts = [" " * 2_000_000 + "a", "\n" * 1_500_000 + " b", "c"]
    docs = spark.createDataFrame([doc(i, t) for i, t in enumerate(texts)], DOC_SCHEMA)
    library = vocabulary.tokenizer()
    got = defaultdict(list)
    for r in packing.pack(docs, broadcast_vocabulary(spark)).select("doc_id", "start", "ids").collect():
        got[r.doc_id].append((r.start, bytes(r.ids)))
    for i, t in enumerate(texts):
        ids = b"".join(x for _, x in sorted(got[i]))
        want = [*library.encode(t, add_special_tokens=False).ids, 0]
        assert np.frombuffer(ids, "<u4").tolist() == want
