from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.llm.conftest import DOC_SCHEMA, WORDS, doc, sentence_text
from tidemark.llm import chunks


def test_boundaries_move_with_the_content():
    raw = sentence_text(1, 900).encode()
    shifted = b"some words put in front " + raw
    a = {raw[s:e] for s, e in zip([0, *chunks.boundaries(raw)], chunks.boundaries(raw))}
    b = {shifted[s:e] for s, e in zip([0, *chunks.boundaries(shifted)],
                                      chunks.boundaries(shifted))}
    assert len(a & b) >= len(a) - 3


def test_chunks_cover_the_text_in_whole_code_points():
    for text in ("", "a", "x" * 5000, "é" * 5000, "漢字 " * 2000, " " * 4000, sentence_text(2),
                 "👍🏽" * 3000, "a b " * 3000):
        raw = text.encode()
        ends = chunks.boundaries(raw)
        assert (ends[-1] if ends else 0) == len(raw) and ends == sorted(set(ends))
        for s, e in zip([0, *ends], ends):
            raw[s:e].decode()
            assert e - s <= chunks.DEFAULT.longest


def brute(rows, cuts=chunks.DEFAULT):
    """Cleaned text per position, for rows of (key, text); ids are keys."""
    owner: dict = {}
    for key, text in rows:
        if text is not None:
            raw = text.encode()
            for d in chunks.digests(raw, chunks.boundaries(raw, cuts)):
                owner[d] = min(owner.get(d, key), key)
    out = []
    for key, text in rows:
        if text is None:
            out.append(None)
            continue
        raw = text.encode()
        ends = chunks.boundaries(raw, cuts)
        made, seen, flags = chunks.digests(raw, ends), set(), []
        for d in made:
            flags.append(owner[d] < key or d in seen)
            seen.add(d)
        kept, at, i = b"", 0, 0
        while i < len(ends):
            j = i
            while j < len(ends) and flags[j] == flags[i]:
                j += 1
            part = raw[at:ends[j - 1]]
            words = sum(len(raw[s:e].split()) for s, e in
                        zip([at, *ends[i:j - 1]], ends[i:j]))
            if not flags[i] or words < cuts.min_words:
                kept += part
            at, i = ends[j - 1], j
        out.append(kept.decode())
    return out


def test_against_brute_force(spark, odd_docs, no_docs):
    r = random.Random(2)
    passages = [" ".join(r.choice(WORDS) + str(r.randint(0, 999)) for _ in range(60))
                for _ in range(4)]
    rows = [doc(i, sentence_text(i) + "\n" + r.choice(passages) + ".\n" + sentence_text(100 + i)
                + ("\n" + passages[0] if i % 3 == 0 else "")) for i in range(24)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    done = chunks.deduplicate(docs).select("doc.doc_id", "text", "spans", "owners").collect()
    want = dict(zip([d[0] for d in rows], brute([(d[0], d[1]) for d in rows])))
    old = {d[0]: d[1] for d in rows}
    for d in done:
        assert d.text == want[d.doc_id]
        left, at = "", 0
        for s in d.spans:
            left, at = left + old[d.doc_id][at:s.start], s.end
        assert left + old[d.doc_id][at:] == d.text
        assert all(o < d.doc_id for o in d.owners)
    # Every passage stays whole in its first document and nearly vanishes from the others.
    texts = sorted((d.doc_id, d.text) for d in done)
    for p in passages:
        words = p.split()
        windows = [" ".join(words[i:i + 40]) for i in range(len(words) - 39)]
        assert sum(any(w in t for w in windows) for _, t in texts) <= 1
    alone = spark.createDataFrame([doc(i, sentence_text(500 + i)) for i in range(10)], DOC_SCHEMA)
    assert all(not x.spans for x in chunks.deduplicate(alone).collect())
    got = chunks.deduplicate(odd_docs).select("doc.doc_id", "doc.text", "text").toDF(
        "doc_id", "old", "new").collect()
    assert len(got) == odd_docs.count()
    by_id = {(r.doc_id, r.old is None): r for r in got}
    assert by_id[(1, False)].new == by_id[(1, False)].old      # repeated rows are one document
    assert by_id[(2, False)].new.strip() == ""                 # a copy of document 1
    assert by_id[(3, True)].new is None and by_id[(4, False)].new == ""
    assert by_id[(None, False)].new == by_id[(None, False)].old
    kept = chunks.without_repeats(odd_docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == odd_docs.columns and 2 not in ids and 4 in ids and ids.count(1) == 2
    assert chunks.deduplicate(no_docs).count() == 0 == chunks.without_repeats(no_docs).count()


def uncut(a: str, b: str, passage: str) -> int:
    """How many code points of ``passage`` stay in ``b``, the later document."""
    raw, other = b.encode(), a.encode()
    spans = chunks.repeats(raw, set(chunks.digests(other, chunks.boundaries(other))))
    at = raw.index(passage.encode())
    end = at + len(passage.encode())
    gone = [raw[max(x, at):min(y, end)] for x, y in spans if x < end and y > at]
    assert sum(len((raw[x:y]).decode()) for x, y in spans) <= len(passage) + 4
    return len(passage) - sum(len(g.decode()) for g in gone)


def test_repeats_without_white_space(spark):
    r = random.Random(4)
    scripts = {"han": [chr(c) for c in range(0x4E00, 0x5E00)],
               "kana": [chr(c) for c in range(0x3041, 0x3097)],
               "thai": [chr(c) for c in range(0x0E01, 0x0E2F)],
               "base64": list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")}
    for name, letters in scripts.items():
        def text(n):
            return "".join(r.choices(letters, k=n))
        unit = len(letters[0].encode())
        for _ in range(150):
            p = text(-(-300 // unit))                     # worth 50 words
            left = uncut(text(r.randint(0, 400)) + p + text(r.randint(0, 400)),
                         text(r.randint(0, 400)) + p + text(r.randint(0, 400)), p)
            assert left * unit <= 300 - 120, name
        assert uncut(text(500), text(500), "") == 0
        p = text(3000)
        assert uncut(p, p, p) == 0
        # Lines, and a long run between words.
        lines = "\n".join(text(40) for _ in range(12))
        assert uncut("some words " + lines, text(90) + "\n" + lines, lines) * unit <= 160
        assert uncut("one two " + p + " three", "four " + p + " five", p) * unit <= 160
    page = "".join(r.choices(scripts["han"], k=3000))
    docs = spark.createDataFrame([doc(1, page), doc(2, page), doc(3, "前" + page[900:1100] + "后")],
                                 DOC_SCHEMA)
    got = {d.doc_id: d for d in chunks.deduplicate(docs).select(
        "doc.doc_id", "text", "owners").collect()}
    assert got[1].text == page and got[2].text == "" and len(got[3].text) < 70
    assert got[2].owners == got[3].owners == [1]


def test_no_passage_of_50_words_is_missed():
    r = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    few = ["ab", "very", "c", "well"]

    def words(n, least, most):
        return [r.choice(few) if most == 0 else "".join(r.choices(letters, k=r.randint(least, most)))
                for _ in range(n)]

    for least, most in ((2, 8), (1, 5), (1, 1), (5, 24), (0, 0)):
        for trial in range(600):
            p = words(50, least, most)
            if trial % 10 == 0:                               # repeats itself
                p = (p[:trial % 7 + 1] * 50)[:50]
            a, b = (words(30, 2, 8) + p + words(30, 2, 8) for _ in range(2))
            if trial % 2:
                a[10] = b[90] = "https://example.org/a/long/run/without/spaces"
            raw, other = " ".join(b).encode(), " ".join(a).encode()
            foreign = set(chunks.digests(other, chunks.boundaries(other)))
            spans = chunks.repeats(raw, foreign)
            assert sum(len(raw[x:y].split()) for x, y in spans) >= 20, (least, most, trial)
    # Every window of words has a boundary, and digests cover no less than the hash.
    raw = " ".join(words(4000, 1, 8)).encode()
    ends = chunks.boundaries(raw)
    assert max(len(raw[s:e].split()) for s, e in zip([0, *ends], ends)) <= chunks.DEFAULT.window


def test_many_rows_of_one_id_are_linear(spark):
    text = sentence_text(77, 300)
    rows = [doc(1, text)] + [doc(5, text)] * 3000
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    sizes = chunks.foreign_chunks(docs).groupBy("key").agg(
        F.size(F.collect_set(F.struct("digest", "owner"))).alias("n")).collect()
    assert [r.n for r in sizes] and sizes[0].n < 400
    done = chunks.deduplicate(docs).select("doc.doc_id", F.octet_length("text").alias("n")).collect()
    assert len(done) == 3001 and {r.n for r in done if r.doc_id == 5} == {0}
