from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF001
from tests.llm.conftest import DOC_SCHEMA, doc, sentence_text
from tests.llm.test_chunks import brute
from tests.llm.test_simhash import brute_components, slow_fingerprint
from tests.llm.test_tokens import check_pieces
from tidemark.llm import line_rules, quality
from tidemark.llm.common import documents, staged
from tidemark.llm.vocabulary import Vocabulary, default_path
from tidemark.sources.tables import table

NAMES = ["quality_rules", "quality_classifier", "simhash_near_dedup", "substring_dedup", "packing"]


def test_every_stage_against_brute_force(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = documents(spark, SF001)
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = rows
        frame = stage(spark, docs, SF001)
        if name == "packing":
            break
        docs = staged(frame, "t")
        assert docs.columns == columns
        rows = {r.doc_id: r for r in docs.collect()}
        if name == "quality_rules":
            want = {i: line_rules.judge_text(r.text) for i, r in before.items()}
            assert {i: r.text for i, r in rows.items()} == {
                i: w[-1] for i, w in want.items() if w[-2]}
        elif name == "quality_classifier":
            model = quality.fit(documents(spark, SF001), table(spark, SF001, "labels"))
            texts = spark.createDataFrame([(i, r.text) for i, r in before.items()],
                                          "doc_id long, text string")
            score = {r.doc_id: r.s for r in texts.select(
                "doc_id", quality.score("text", model).alias("s")).collect()}
            assert set(rows) == {i for i, s in score.items() if s >= 0.7}
        elif name == "simhash_near_dedup":
            ids = sorted(before)
            low = brute_components([(i, slow_fingerprint(before[i].text)) for i in ids])
            assert sorted(rows) == sorted({i for i, c in zip(ids, low) if i == c})
            assert all(rows[i] == before[i] for i in rows)
        else:
            ids = sorted(before)
            want = dict(zip(ids, brute([(i, before[i].text) for i in ids])))
            assert {i: r.text for i, r in rows.items()} == {
                i: t for i, t in want.items() if t.split() or t == before[i].text}
        assert all(r.n_chars == len(r.text) for r in rows.values())
    with open(default_path(), "rb") as f:
        library = Vocabulary(f.read()).tokenizer()
    check_pieces(frame.collect(), [
        (i, library.encode(r.text, add_special_tokens=False).ids + [0])
        for i, r in rows.items()], 1024)


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            out = stage(spark, docs, SF001)
            if name != "packing":
                assert out.columns == docs.columns
            n = out.count()
            assert docs is odd_docs or n == 0


def test_clean_documents_pass_all_filters(spark):
    docs = spark.createDataFrame([doc(i, sentence_text(i, 180)) for i in range(40)], DOC_SCHEMA)
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF001)
    assert kept.select("doc_id", "text").subtract(docs.select("doc_id", "text")).count() == 0
    assert kept.count() == 40
    near = corpus_pipeline.STAGES[2][1](spark, docs, SF001)
    assert near.count() == 40
    last = corpus_pipeline.STAGES[3][1](spark, docs, SF001)
    assert last.agg(F.sum(F.length("text"))).first()[0] == docs.agg(F.sum("n_chars")).first()[0]
