"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

A document is described by statistics of its text.  Random Fourier features
of the standardised statistics approximate a Gaussian kernel; each partition
of the training rows adds up its part of the normal equations, the driver
sums these few small matrices and solves for the ridge weights.  Scores of
folds that a fit has not seen are calibrated by isotonic regression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemark.llm import characters as ch
from tidemark.llm.common import held_out, staged
from tidemark.llm.line_rules import SPACE, SYMBOLS, TERMINAL, repeated_words

MAX_TRAIN_ROWS = 20_000     # the fit's bound: labelled rows, sampled by a hash of id and text
FEATURES = 256
BANDWIDTH = 3.0             # of the Gaussian kernel, in standard deviations
RIDGE = 1.0
FOLDS = 4
SLACK = 1.1                 # a sample by hash may exceed its bound by so much
TRAIN_PARTITIONS = 16       # partial normal equations that reach the driver, per fold
SEED = 11
THRESHOLD = 0.7


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text; null is the empty text."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    chars = np.bincount(ch.class_table()[ch.code_points(text)], minlength=7).astype(float)
    solid = max(1.0, chars.sum() - chars[ch.SPACE])
    letters = max(1.0, chars[ch.UPPER] + chars[ch.LETTER])
    sizes = np.fromiter(map(len, words), np.int64, n)
    distinct = len(set(words))
    lines = [s for s in text.split("\n") if s.strip(SPACE)]
    ended = sum(s.rstrip(SPACE).endswith(tuple(TERMINAL)) for s in lines)
    symbols = sum(map(text.count, SYMBOLS))
    return [
        np.log1p(n), np.log1p(len(lines)), sizes.mean() if n else 0.0, sizes.std() if n else 0.0,
        chars[ch.UPPER] / letters, letters / solid, chars[ch.DIGIT] / solid,
        chars[ch.PUNCTUATION] / solid, chars[ch.SYMBOL] / solid, symbols / max(1, n),
        text.count("!") / max(1, n), text.count("|") / max(1, n),
        distinct / max(1.0, n) ** 0.8, repeated_words(words) / max(1, n),
        1 - len(set(lines)) / max(1, len(lines)), ended / max(1, len(lines)),
        float((sizes <= 3).mean()) if n else 0.0, np.log1p(n / max(1, len(lines))),
    ]


def _statistics(text: Column | str) -> Column:
    @F.arrow_udf(ArrayType(DoubleType()))
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    return run.asNondeterministic()(text)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit (pool adjacent violators);
    equal ``x`` are one point.  Each block stands at its mean ``x``."""
    xs, at = np.unique(x, return_inverse=True)
    weights = np.bincount(at).astype(float)
    means = np.bincount(at, y) / weights
    blocks: list[list[float]] = []      # mean y, weight, sum of weighted x
    for v, w, p in zip(means, weights, xs):
        blocks.append([v, w, p * w])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, p2 = blocks.pop()
            v1, w1, p1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, p1 + p2]
    b = np.array(blocks)
    return b[:, 2] / b[:, 1], np.clip(b[:, 0], 0.0, 1.0)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.scale, self.frequencies, self.phases) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.round(np.interp(self.raw(x), self.knots, self.values), 6)


def fourier(x, mean, scale, frequencies, phases) -> np.ndarray:
    """Fourier features of the standardised rows, and a constant column."""
    z = np.clip((x - mean) / scale, -8, 8) @ frequencies + phases
    return np.hstack([np.cos(z) * np.sqrt(2 / len(phases)), np.ones((len(x), 1))])


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _below(bound: int, n: int, *of: str) -> Column:
    """True for about ``bound`` of ``n`` rows at most, by a hash of the columns."""
    grain = 1 << 30
    return (F.pmod(F.xxhash64(*of, F.lit(SEED)), F.lit(grain))
            < int(min(1.0, bound / max(1, n)) * grain))


def _sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``(y, fold, x)`` of the rows the fit may see, about ``bound`` at most: first of
    the labelled ids, then of their distinct texts, since an id may be on any number
    of rows."""
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
                        & ~held_out(F.col("doc_id")))
           .select(F.col("doc_id").cast("long").alias("doc_id"),
                   F.col("quality").cast("double").alias("y")).distinct())
    some = F.broadcast(ids.where(_below(bound, ids.count(), "doc_id")))   # ``bound`` rows
    found = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                   .join(some, "doc_id")
                   .select("doc_id", "y", F.xxhash64("text").alias("h"),
                           _statistics("text").alias("x")), "quality-train")
    rows = found.groupBy("doc_id", "y", "h").agg(F.first("x").alias("x"))
    n = found.select("doc_id", "y", "h").distinct().count()
    return rows.where(_below(bound, n, "doc_id", "h") if n > bound * SLACK else F.lit(True)).select(
        "y", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold"), "x")


def fit(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN_ROWS) -> Model | None:
    """The model learned from ``labels(doc_id, quality)`` and the texts of
    ``docs`` outside the held-out fold; None where no such row exists.

    Null ids and labels other than 0 and 1 teach nothing; a document under two
    labels, or an id with two texts, counts once for each; equal rows count once."""
    rows = staged(_sample(docs, labels, bound), "quality-sample")
    width = len(statistics(""))
    moments = rows.agg(F.count("*"), *[f(F.col("x")[i]) for i in range(width)
                                       for f in (F.mean, F.stddev_pop)]).first()
    if not moments[0]:
        return None
    mean = np.array(moments[1::2], float)
    scale = np.maximum(np.array(moments[2::2], float), 1e-6)
    draw = np.random.default_rng(SEED)
    frequencies = draw.normal(size=(width, FEATURES)) / (BANDWIDTH * np.sqrt(width / 6))
    phases = draw.uniform(0, 2 * np.pi, FEATURES)
    size = FEATURES + 1

    def equations(batches):
        sums = {}
        for b in batches:
            x = fourier(_matrix(b.column(2), width), mean, scale, frequencies, phases)
            y, fold = b.column(0).to_numpy(), b.column(1).to_numpy()
            for k in np.unique(fold):
                own, target = x[fold == k], y[fold == k]
                part = np.vstack([own.T @ own, own.T @ target])
                sums[int(k)] = sums.get(int(k), 0) + part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["fold", "part"])

    parts = rows.coalesce(TRAIN_PARTITIONS).mapInArrow(
        equations, "fold int, part binary").collect()
    of_fold = {k: np.zeros((size + 1, size)) for k in range(FOLDS)}
    for r in sorted(parts, key=lambda r: (r.fold, bytes(r.part))):
        of_fold[r.fold] = of_fold[r.fold] + np.frombuffer(r.part).reshape(size + 1, size)
    total = sum(of_fold.values())

    def solve(m: np.ndarray) -> np.ndarray:
        penalty = RIDGE * np.eye(size)
        penalty[-1, -1] = 1e-9              # the constant is not shrunk
        return np.linalg.solve(m[:size] + penalty, m[size])

    # Out-of-fold scores of the bounded sample, for the calibration.
    seen = rows.select("y", "fold", "x").toArrow()
    x = np.array(seen.column("x").to_pylist(), float)
    y, fold = seen.column("y").to_numpy(), seen.column("fold").to_numpy()
    features = fourier(x, mean, scale, frequencies, phases)
    raw = np.empty(len(y))
    for k, own in of_fold.items():
        some = (fold == k) if len(set(fold)) > 1 else (fold >= 0)
        left_out = total - own if len(set(fold)) > 1 else total
        raw[some] = features[some] @ solve(left_out)
    knots, values = isotonic(raw, y)
    return Model(mean, scale, frequencies, phases, solve(total), knots, values)


def score(text: Column | str, model: Model | None) -> Column:
    """The calibrated score of each text, empty and null ones included; 0.5
    where nothing could be learned."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf(DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        rows = [statistics(t) for t in texts.to_pylist()]
        return pa.array(model.score(np.array(rows)) if rows else [], pa.float64())

    return run.asNondeterministic()(text)
