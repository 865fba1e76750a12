from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOC_SCHEMA, doc, sentence_text
from tidemark.llm import queries, runs


def brute(words):
    """All maximal runs, period by period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check(texts):
    for words, (found, text) in zip(texts, runs.runs_of([" ".join(w).encode() for w in texts])):
        want = brute(words)
        assert found == want, words
        assert text.decode() == collapsed(words, want)


def test_random_texts_of_few_words():
    r = random.Random(4)
    for _ in range(1500):
        texts = []
        for _ in range(r.randint(1, 5)):
            k, n = r.choice([1, 2, 2, 3, 5, 30]), r.choice([0, 1, 5, 6, 7, 8, 20, 60, 150])
            w = [str(r.randrange(k)) for _ in range(n)]
            if n and r.random() < 0.6:
                a = r.randrange(n)
                p = 1 + (n - a) // r.randint(3, 11)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        check(texts)


@pytest.mark.parametrize("make", [
    lambda i: "ab"[i.bit_count() % 2], lambda i: "ab"[(i * 21 // 34 + i) % 2],
    lambda i: str(i % 7 if i < 300 else i % 3), lambda i: "x" if i % 50 else "y",
    lambda i: str((i & -i).bit_length())])
def test_structured_texts(make):
    check([[make(i) for i in range(700)], [], [make(i) for i in range(40)]])


def test_work_is_per_nonterminal():
    words = [f"w{i % 1000}" for i in range(300_000)]
    (found, text), = runs.runs_of([" ".join(words).encode()])
    assert found == [(0, 300_000, 1000)] and text.decode() == " ".join(words[:1000])
    (found, text), = runs.runs_of([b"x " * 400_000])
    assert found == [(0, 400_000, 1)] and text == b"x"
    import numpy as np
    ids = np.array([i % 1000 for i in range(300_000)])
    g = runs.Grammar(ids, np.zeros(len(ids), int))
    assert len(g.start) < 5000 < len(g.at)


def test_a_false_hash_match_is_noticed(monkeypatch):
    honest = runs._Prefixes

    class Liar(honest):
        def __init__(self, ids, seed):
            super().__init__(ids, seed)
            self.lie = seed == 1

        def equal(self, i, j, length):
            same = super().equal(i, j, length)
            return same | self.lie

    monkeypatch.setattr(runs, "_Prefixes", Liar)
    check([["a", "b", "c"] * 8 + ["d", "e", "f", "g"] * 9 + ["a", "b", "c"] * 2])


def test_query_against_brute_force(spark, odd_docs, no_docs, monkeypatch):
    r = random.Random(8)
    rows = [doc(i, " ".join(r.choice("abc") for _ in range(r.randint(0, 90)))) for i in range(150)]
    rows += [doc(i, sentence_text(i, 27)) for i in range(150, 300)] + [doc(41, None)]
    plain = spark.createDataFrame(rows, DOC_SCHEMA)
    odd = odd_docs.where("octet_length(text) < 100000 or text is null")
    for docs in (plain, odd, no_docs):
        monkeypatch.setattr(queries, "documents", lambda *_: docs)
        want = []
        for row in docs.select("doc_id", "text").collect():
            words = (row.text or "").encode().split()
            h = zlib.crc32(("" if row.doc_id is None else str(row.doc_id)).encode())
            g, n = h // 10, len(words)
            if h % 10 == 0 and n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            words = [w.decode() for w in words]
            found = brute(words)
            best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
            digests = ["".join(f"{a},{b},{c}\n" for a, b, c in found), collapsed(words, found)]
            want.append((row.doc_id, len(found), *(best or (None,) * 3),
                         best and 1000 * best[1] // best[2],
                         *[hashlib.sha256(d.encode()).hexdigest() for d in digests]))
        got = [tuple(x) for x in queries.op11_periodic_runs(spark, "").collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_long_text_in_spark(spark):
    text = "x" * 200_000 + " y" * 200_000
    row = spark.createDataFrame([(text,)], "t string").select(runs.periodic_runs("t").alias("r"))
    r = row.first().r
    assert [tuple(x) for x in r.runs] == [(1, 200_000, 1)] and tuple(r.best) == (1, 200_000, 1)
    assert r.collapsed == "x" * 200_000 + " y"
    types = dict(row.select("r.*").dtypes)
    assert types["collapsed"] == "string" and F.col("r") is not None
