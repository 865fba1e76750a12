from __future__ import annotations

import random

import xxhash

from tests.llm.conftest import DOC_SCHEMA, doc, sentence_text
from tidemark.llm import simhash
from tidemark.llm.components import connected_components


def slow_fingerprint(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits=2):
    """rows of (doc_id, fp) -> {position: smallest id reachable}."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(rows))]


def test_fingerprint_matches_bit_by_bit_votes():
    for text in (None, "", "One", "one TWO", "Éa b\x0bc\xa0d e", sentence_text(3), "a b c " * 50):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_components_against_brute_force(spark, monkeypatch):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(6)]
    fps = set(base)
    for b in base[:3]:                                  # chains and dense balls
        f = b
        for _ in range(60):
            f ^= (1 << r.randrange(64)) ^ (1 << r.randrange(64))
            fps.add(f)
        fps |= {b ^ (1 << i) for i in range(40)}
    fps = sorted(fps)
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    want = brute_components(list(enumerate(fps)))
    for limit in (1, 32, 10_000):                       # crowded keys, mixed, pairs only
        monkeypatch.setattr(simhash, "PAIR_LIMIT", limit)
        edges = simhash.links(frame)
        for e in edges.collect():
            assert ((e.a ^ e.b) & (2 ** 64 - 1)).bit_count() <= 2
        label = {r.node: r.label for r in connected_components(edges).collect()}
        index = {simhash._signed(f): i for i, f in enumerate(fps)}
        groups: dict = {}
        for s, i in index.items():
            groups.setdefault(label.get(s, s), set()).add(i)
        expected: dict = {}
        for i, c in enumerate(want):
            expected.setdefault(c, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_odd_rows_and_kept_documents(spark, odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    plain = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert len(rows) == len(plain)
    want = brute_components([(d, slow_fingerprint(t)) for d, t in plain])
    assert sorted(((r.doc_id, r.component_id) for r in rows), key=repr) == sorted(
        ((d, c) for (d, _), c in zip(plain, want)), key=repr)
    kept = simhash.keep_one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # The copies 1, 1, 2 leave one row, as do the wordless ones 3, 4, 6 and null.
    assert ids.count(1) == 1 and 2 not in ids and ids.count(3) == 1 and 4 not in ids
    assert ids.count(None) == 1 and {7, 8, 9, 10} <= set(ids)
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one_per_group(no_docs).count() == 0


def test_one_id_with_two_texts(spark):
    docs = spark.createDataFrame([doc(5, sentence_text(1)), doc(5, sentence_text(2)),
                                  doc(6, sentence_text(2))], DOC_SCHEMA)
    kept = simhash.keep_one_per_group(docs).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(
        [(5, sentence_text(1)), (5, sentence_text(2))])


def test_kept_rows_keep_columns_of_any_name_and_type(spark):
    rows = [(1, "a b c d", "k", 7, 2, "x.y", {"m": "n"}), (1, "a b c d", "j", 7, 2, "x.y", {"m": "o"}),
            (2, "a b c d", "l", 8, 3, "z", None), (None, "q r s", "m", 9, 4, None, {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, _hash int, _nth int, "
                                       "`a.b` string, m map<string,string>")
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[3]], key=str)
    two = docs.select("doc_id", "text")
    assert simhash.keep_one_per_group(two).count() == 2
