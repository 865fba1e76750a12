"""Language identification in two steps.

Linear support vector machines over hashed character n-grams first choose the
language family, one against the rest; within the family, one machine per
pair of languages votes for the language.  Languages of no known family join
the family, known or new, whose mean profiles are most like theirs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, FloatType, StringType, StructField,
                               StructType)

from tidemark.llm import characters as ch
from tidemark.llm.common import held_out, staged

MAX_TRAIN_ROWS = 6_000      # the fit's bound, shared evenly by the languages
MAX_LANGUAGES = 128         # that are learned: those of the most rows
BINS = 4096
ORDERS = (1, 2, 3)
EPOCHS, STEP, SHRINK, SEED = 30, 64, 1e-4, 7
UNDETERMINED = "und"

# Families of common languages; those of others are learned.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)    # odd multipliers


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def profile(text: str) -> np.ndarray:
    """Square roots of the shares of hashed n-grams of letters, of length one.
    Runs of anything but letters are one blank."""
    codes = ch.code_points(text.lower())
    letter = ch.class_table()[codes] <= ch.LETTER
    codes = np.where(letter, codes, np.uint32(32))
    codes = codes[letter | np.append(True, letter[:-1])]
    out = np.zeros(BINS)
    for n in ORDERS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, np.uint32)
        for k in range(n):
            h = (h ^ codes[k:len(codes) - n + 1 + k]) * _MIX[k]
            h ^= h >> np.uint32(15)
        share = np.bincount(h & np.uint32(BINS - 1), minlength=BINS)
        out += share / (share.sum() * len(ORDERS))
    return np.sqrt(out)


def train_svm(x: np.ndarray, rows: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights (the last one is the constant) by averaged sub-gradient steps on
    the hinge loss over ``rows`` of ``x``; both sides weigh the same.  ``x`` is
    never copied as a whole."""
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    share = share * len(y)
    w, mean, done = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), 0
    draw = np.random.default_rng(SEED)
    for epoch in range(EPOCHS):
        rate = 4.0 / (1 + epoch)
        order = draw.permutation(len(y))
        for at in range(0, len(order), STEP):
            some = order[at:at + STEP]
            part = x[rows[some]]
            wrong = y[some] * (part @ w[:-1] + w[-1]) < 1
            w *= 1 - rate * SHRINK
            if wrong.any():
                pull = (y[some] * share[some])[wrong] * (rate / len(some))
                w[:-1] += pull @ part[wrong]
                w[-1] += pull.sum()
            if epoch >= EPOCHS // 2:
                mean += w
                done += 1
    return mean / max(1, done)


@dataclass
class Model:
    families: list[str]
    of_family: dict[str, list[str]]
    family_weights: np.ndarray                          # one row per family
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        x = np.append(x, 1.0)
        if len(self.families) > 1:
            margins = self.family_weights @ x
            best = int(np.argmax(margins))
            sure = _squash(margins[best] - np.delete(margins, best).max())
        else:
            best, sure = 0, 1.0
        langs = self.of_family[self.families[best]]
        if len(langs) == 1:
            return langs[0], sure
        votes = dict.fromkeys(langs, 0.0)
        for a, b in combinations(langs, 2):
            m = float(self.pairs[a, b] @ x)
            votes[a if m >= 0 else b] += 1 + _squash(abs(m)) / (2 * len(langs))
        won = max(votes, key=votes.get)
        margin = min(float(self.pairs[a, b] @ x) * (1 if a == won else -1)
                     for a, b in self.pairs if won in (a, b))
        return won, sure * _squash(margin)


def _squash(margin: float) -> float:
    return float(1 / (1 + np.exp(-2 * np.clip(margin, -30, 30))))


def families_of(centroids: dict[str, np.ndarray]) -> dict[str, str]:
    """The family of each language: the known one or, for a language that has none,
    by joining the two groups whose mean profiles are most alike (mean cosine over
    their pairs), as long as they are no less so than languages are on average.  Two
    known families are never joined; a new one is named after a language of it."""
    langs = sorted(centroids)
    unit = np.array([centroids[v] / np.linalg.norm(centroids[v]) for v in langs])
    cosine = unit @ unit.T
    groups: dict[str, list[int]] = {}
    for i, v in enumerate(langs):
        groups.setdefault(_FAMILY.get(v, f"like {v}"), []).append(i)
    average = cosine[np.triu_indices(len(langs), 1)].mean() if len(langs) > 1 else 1.0
    while True:
        pairs = [(cosine[np.ix_(groups[a], groups[b])].mean(), a, b)
                 for a, b in combinations(sorted(groups), 2)
                 if a not in FAMILIES or b not in FAMILIES]
        alike, a, b = max(pairs, default=(-1.0, "", ""), key=lambda p: p[0])
        if alike < average:
            return {langs[i]: name for name, own in groups.items() for i in own}
        kept, gone = (b, a) if b in FAMILIES else (a, b)
        groups[kept] += groups.pop(gone)


def _sample(docs: DataFrame, bound: int) -> DataFrame | None:
    """``(lang, text)``: distinct rows the fit may see, about ``bound`` at most and about
    as many of each language, chosen by a hash of id and text; None where there are
    none."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & ~held_out(F.col("doc_id"))).select(
        "lang", "text", F.xxhash64("doc_id", "text", F.lit(SEED)).alias("h"))
    # Copies count once, so a hot row neither fills the sample nor thins out the others.
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).orderBy(
        F.desc("n"), "lang").limit(min(bound, MAX_LANGUAGES)).collect()
    if not counts:
        return None
    each, grain = max(1, bound // len(counts)), 1 << 30
    shares = F.broadcast(docs.sparkSession.createDataFrame(
        [(r.lang, int(min(1.0, each / max(1, r.n)) * grain)) for r in counts],
        "lang string, below long"))         # MAX_LANGUAGES rows at most
    return rows.join(shares, "lang").where(F.pmod("h", F.lit(grain)) < F.col("below")).groupBy(
        "lang", "h").agg(F.first("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, bound: int = MAX_TRAIN_ROWS) -> Model | None:
    """The model learned from ``docs(doc_id, text, lang)`` outside the held-out
    fold, from ``bound`` rows at most (see ``_sample``; equal rows are one, and only
    the ``MAX_LANGUAGES`` languages of the most rows are learned); None where no row
    has both a language and a letter."""
    @F.arrow_udf(ArrayType(FloatType()))
    def profiles(texts: pa.Array) -> pa.Array:
        return pa.array([profile(t) if has_letter(t) else None for t in texts.to_pylist()],
                        pa.list_(pa.float32()))

    rows = _sample(docs, bound)
    if rows is None:
        return None
    seen = staged(rows.select("lang", profiles("text").alias("x")), "language-train") \
        .where("x is not null").toArrow()
    if not seen.num_rows:
        return None
    lang = np.array(seen.column("lang").to_pylist())
    x = np.empty((len(lang), BINS), np.float32)
    at = 0
    for chunk in seen.column("x").chunks:
        x[at:at + len(chunk)] = chunk.flatten().to_numpy().reshape(-1, BINS)
        at += len(chunk)
    del seen
    langs = sorted(set(lang.tolist()))
    family_of = families_of({v: x[lang == v].mean(0, dtype=np.float64) for v in langs})
    family = np.array([family_of[v] for v in lang])
    families = sorted(set(family.tolist()))
    of_family = {f: [v for v in langs if family_of[v] == f] for f in families}
    model = Model(families, of_family, np.zeros((len(families), BINS + 1)))
    if len(families) > 1:
        model.family_weights = np.array([train_svm(x, np.arange(len(x)), family == f)
                                         for f in families])
    for f in families:
        for a, b in combinations(of_family[f], 2):
            some = np.flatnonzero((lang == a) | (lang == b))
            model.pairs[a, b] = train_svm(x, some, lang[some] == a)
    return model


PREDICTION = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])


def predict(text: Column | str, model: Model | None) -> Column:
    """``struct(lang, score)`` of each whole text; ``und`` with score 0 where it is
    null, has no letter, or nothing could be learned."""

    def one(text):
        if model is None or not has_letter(text):
            return UNDETERMINED, 0.0
        return model.predict(profile(text))

    @F.arrow_udf(PREDICTION)
    def run(texts: pa.Array) -> pa.Array:
        found = [one(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()),
             pa.array([round(f[1], 6) for f in found], pa.float64())], ["lang", "score"])

    return run.asNondeterministic()(text)
