from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidemark.llm import characters as ch
from tidemark.llm import language, quality
from tests.llm.conftest import DOC_SCHEMA, doc, sentence_text
from tidemark.llm.common import documents, held_out
from tidemark.llm.queries import QUERIES
from tidemark.sources.tables import table


def test_isotonic_is_the_least_squares_monotone_fit():
    r = np.random.default_rng(1)
    for n in (1, 2, 9, 60):
        x, y = np.round(r.normal(size=n), 1), r.integers(0, 2, n).astype(float)
        knots, values = quality.isotonic(x, y)
        assert (np.diff(knots) > 0).all() and (np.diff(values) > 0).all()
        # Min-max formula of isotonic regression, by brute force.
        xs = np.unique(x)
        best = [max(min(y[(x >= a) & (x <= b)].mean() for b in xs if b >= v)
                    for a in xs if a <= v) for v in xs]
        assert np.allclose(np.unique(np.round(best, 9)), np.round(values, 9))


def test_partition_sums_equal_one_ridge_solve(spark):
    docs, labels = documents(spark, SF01), table(spark, SF01, "labels")
    model = quality.fit(docs.repartition(5), labels)
    seen = docs.join(labels, "doc_id").where(~held_out(F.col("doc_id"))).select(
        "text", "quality").collect()
    x = quality.fourier(np.array([quality.statistics(r.text) for r in seen]), model.mean,
                        model.scale, model.frequencies, model.phases)
    y = np.array([r.quality for r in seen], float)
    penalty = quality.RIDGE * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-9
    assert np.allclose(model.weights, np.linalg.solve(x.T @ x + penalty, x.T @ y), atol=1e-6)


def test_quality_on_held_out_rows(spark):
    rows = QUERIES["op1_quality_classifier"](spark, SF01).join(
        table(spark, SF01, "labels"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(odd_docs, none) is None and quality.fit(no_docs, none) is None
    assert odd_docs.select(quality.score("text", None).alias("s")).first().s == 0.5
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (9, 0), (None, 1), (8, None), (7, 1),
                                    (4, 0), (10, 0), (8, 1)], "doc_id long, quality int")
    model = quality.fit(odd_docs, labels)
    scores = [r.s for r in odd_docs.select(quality.score("text", model).alias("s")).collect()]
    assert len(scores) == odd_docs.count() and all(0 <= s <= 1 for s in scores)
    one_sided = quality.fit(odd_docs, labels.where("quality = 1"))
    assert all(r.s == 1 for r in odd_docs.select(quality.score("text", one_sided).alias("s"))
               .collect())
    assert no_docs.select(quality.score("text", model)).count() == 0


def test_language_on_held_out_rows(spark):
    rows = QUERIES["op5_language_id"](spark, SF01).join(
        documents(spark, SF01).select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    assert language.fit(no_docs) is None
    model = language.fit(documents(spark, SF01))
    for m in (None, model):
        found = odd_docs.select("text", language.predict("text", m).alias("p")).collect()
        for r in found:
            if m is None or not language.has_letter(r.text):
                assert tuple(r.p) == ("und", 0.0)
            else:
                assert r.p.lang in ("de", "en", "es", "fr") and 0 <= r.p.score <= 1
    single = language.fit(odd_docs.where("lang = 'en'"))
    assert {r.p.lang for r in odd_docs.select(language.predict("text", single).alias("p"))
            .collect()} == {"en", "und"}


def test_family_first_then_pairs(spark):
    model = language.fit(documents(spark, SF01))
    assert model.of_family == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert set(model.pairs) == {("de", "en"), ("es", "fr")}


def test_hot_rows_do_not_fill_the_fits(spark):
    """An id and a row on most rows: the samples keep to their bounds and to distinct rows."""
    same = doc(1, sentence_text(1))
    rows = [same] * 3000 + [doc(1, sentence_text(s)) for s in range(300)]
    rows += [doc(i, sentence_text(i + 1000), "de" if i % 2 else "en") for i in range(2, 200)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(4)
    assert not docs.where(held_out(F.col("doc_id"))).where("doc_id = 1").count()
    labels = spark.createDataFrame([(1, 1), (1, 1)] + [(i, i % 2) for i in range(2, 200)],
                                   "doc_id long, quality int")
    all_rows = quality._sample(docs, labels, 10_000)
    learned = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(2, 200))
    assert all_rows.count() == 300 + learned        # text 1 is one of the 300
    assert 20 <= quality._sample(docs, labels, 100).count() <= 150
    assert quality.fit(docs, labels, 100) is not None
    whole = language._sample(docs, 10_000)
    assert whole.count() == whole.distinct().count() == 300 + learned
    few = {r["lang"]: r["count"] for r in language._sample(docs, 60).groupBy("lang").count().collect()}
    assert set(few) == {"de", "en"} and all(12 <= n <= 55 for n in few.values())


def plain_profile(text):
    """The same profile gram by gram."""
    letters, gap = [], False
    for c in text.lower():
        if ch.class_table()[ord(c)] <= ch.LETTER:
            letters.append(ord(c))
            gap = True
        elif gap or not letters:
            letters.append(32)
            gap = False
    if text and not letters:
        letters = [32]
    out = [0.0] * language.BINS
    for n in language.ORDERS:
        grams = [letters[i:i + n] for i in range(len(letters) - n + 1)]
        for gram in grams:
            h = n
            for k, code in enumerate(gram):
                h = ((h ^ code) * int(language._MIX[k])) % 2 ** 32
                h ^= h >> 15
            out[h % language.BINS] += 1 / (len(grams) * len(language.ORDERS))
    return [v ** 0.5 for v in out]


def test_language_against_brute_force(spark):
    """Predictions of 120 rows of the table, from profiles made gram by gram and from
    all machines in turn."""
    docs = documents(spark, SF01).where("text is not null")
    model = language.fit(docs)
    squash = lambda m: 1 / (1 + math.exp(-2 * m))
    rows = docs.select("text", language.predict("text", model).alias("p")).orderBy(
        F.xxhash64("text")).limit(120).collect()
    for text, p in rows:
        if not language.has_letter(text):
            assert tuple(p) == ("und", 0.0)
            continue
        x = np.array(plain_profile(text) + [1.0])
        by_family = {f: float(w @ x) for f, w in zip(model.families, model.family_weights)}
        family = max(by_family, key=by_family.get)
        rest = max(m for f, m in by_family.items() if f != family)
        wins = {a: [float(model.pairs[k] @ x) * (1 if a == k[0] else -1)
                    for k in model.pairs if a in k] for a in model.of_family[family]}
        lang = max(wins, key=lambda a: sum(m >= 0 for m in wins[a]))
        assert p.lang == lang
        assert abs(p.score - squash(by_family[family] - rest) * squash(min(wins[lang]))) < 1e-4


def test_svm_separates_what_can_be_separated():
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 5)).astype(np.float32)
    side = x @ np.array([1.0, -2.0, 0.5, 0, 0]) > 0.7
    x[side] += [0.3, -0.6, 0.15, 0, 0]
    w = language.train_svm(x, np.arange(300), side)
    assert ((x @ w[:-1] + w[-1] > 0) == side).mean() >= 0.97


def test_families_of_unknown_languages(spark):
    rows = documents(spark, SF01).where("text is not null").select("lang", "text").collect()
    mean = {v: np.mean([language.profile(r.text) for r in rows if r.lang == v], axis=0)
            for v in ("de", "en", "es", "fr")}
    as_is = language.families_of(mean)
    assert as_is == {"de": "germanic", "en": "germanic", "es": "romance", "fr": "romance"}
    # The same texts under codes that no table knows.
    new = language.families_of({f"x{v}": m for v, m in mean.items()})
    assert new["xde"] == new["xen"] != new["xes"] == new["xfr"]
    mixed = language.families_of({"de": mean["de"], "xen": mean["en"], "es": mean["es"],
                                  "xfr": mean["fr"]})
    assert mixed["xfr"] == "romance" and len(set(mixed.values())) == 2
    assert language.families_of({"xx": mean["en"]}) == {"xx": "like xx"}
    assert language.families_of({}) == {}
