from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidemark.llm import ann
from tidemark.sources.tables import table

SCHEMA = "vec_id long, embedding array<float>, uid string, v string, list string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(map(
        lambda x: None if x is None else float(x), v)), "a", "b", "c") for i, v in rows], SCHEMA)


def exact(rows, k):
    """Brute force: {query: [(id, score)]}, float32 components, double products."""
    width = 3
    ok = {i: np.float32(v).astype(float) for i, v in rows if i is not None and v is not None
          and len(v) == width and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in ok:
        if q % 20 == 0:
            near = sorted((-float((ok[i] * ok[q]).sum()), i) for i in ok if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


@pytest.mark.parametrize("lists", [None, 3])
def test_odd_vectors(spark, lists):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=3).round(2).tolist()) for i in range(60)]
    rows += [(i, [1.0, 2.0, 2.0]) for i in range(100, 180)]         # a hot vector
    rows += [(200, None), (201, [0, 0, 0]), (220, [0.0, -0.0, 0]), (203, [1, None, 2]),
             (204, [float("nan"), 1, 1]), (240, [float("inf"), 1, 1]), (None, [1, 1, 1]),
             (260, [1, 1]), (280, []), (0, rows[0][1]), (300, [5, 5, 5])]
    got = {}
    for x in ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20, lists).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    want = exact(rows, 20)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and len(mine) == 20
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        hits += len({m[1] for m in mine} & {i for i, _ in near})
        if lists is None:
            assert [(m[1], round(m[2], 9)) for m in mine] == [(i, round(s, 9)) for i, s in near]
    assert hits >= 0.9 * 20 * len(want)


def test_few_and_no_candidates(spark):
    one = lambda rows: ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert one([]) == [] and one([(20, [1, 1, 1])]) == [] and one([(20, None)]) == []
    assert [tuple(x) for x in one([(20, [1, 0, 0]), (21, [2, 0, 0]), (22, [0, 1, 0])])] == [
        (20, 1, 21, 2.0), (20, 2, 22, 0.0)]


def test_recall_and_pruning(spark):
    vectors = table(spark, SF01, "embeddings")
    rows = vectors.collect()
    x = np.array([r.embedding for r in rows], float)
    ids = np.array([r.vec_id for r in rows])
    got = {}
    for r in ann.nearest(vectors, F.col("vec_id") % 20 == 0, lists=16).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    found = total = 0
    for i, q in enumerate(ids):
        if q % 20 == 0:
            s = x @ x[i]
            s[i] = -np.inf
            best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
            found, total = found + len(best & got[q]), total + 20
    assert found >= 0.9 * total


def test_walk_finds_the_nearest_lists():
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 8)) * 5
    x = np.vstack([c + r.normal(size=(50, 8)) * 0.3 for c in centres])
    index = ann.build_index(x, 64, float((x * x).sum(1).max()))
    index.ratio = 1.2
    for q in x[::97]:
        d = index._far(q)(np.arange(len(index.centroids)))
        want = {n for n in range(len(d)) if d[n] <= d.min() * index.ratio}
        mine = index.probes(q)
        assert len(mine) < len(d) and int(np.argmin(d)) == mine[0]
        assert len(want & set(mine)) >= 0.9 * len(want)
    sizes = np.bincount(index.posts(x)[1], minlength=len(index.centroids))
    assert sizes.max() < 12 * sizes.mean()


def test_dealing_is_bounded(monkeypatch):
    monkeypatch.setattr(ann, "GROUP_VECTORS", 100)
    monkeypatch.setattr(ann, "GROUP_QUERIES", 50)
    plan = ann._deal({0: 60, 1: 30, 2: 950, 3: 40, 4: 70}, {0: 10, 2: 500, 3: 60})
    assert plan == [(0, 0, 1, 1), (1, 0, 1, 1), (2, 1, 10, 10), (3, 11, 1, 2), (4, 12, 1, 1)]


def test_near_empty_lists_give_all_neighbours(spark, monkeypatch):
    r = np.random.default_rng(3)
    centres = np.eye(8)[:4] * 10                    # tight clusters, and a few apart from them
    x = np.vstack([c + r.normal(size=(300, 8)) * 0.01 for c in centres]
                  + [-np.eye(8)[i] * 10 + r.normal(size=(1, 8)) for i in range(8)])
    c = np.vstack([centres, x[-8:]])

    def built(sample, lists, top):
        index = ann.Index(np.empty(0), [], np.empty(0), top)
        index.centroids = index.lengthen(c)
        index.graph = [np.array([j for j in range(12) if j != i]) for i in range(12)]
        index.entries = np.arange(12)
        return index

    monkeypatch.setattr(ann, "build_index", built)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(docs, F.col("vec_id") >= 1200, 20, 12).groupBy("query_id").count().collect()
    assert len(got) == 8 and all(g["count"] == 20 for g in got)


def test_scores_of_double_vectors_are_exact(spark):
    r = np.random.default_rng(9)
    v = r.normal(size=(300, 16)) + 1e-9 * r.normal(size=(300, 16))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"),
                      F.col("vec_id") % 20 == 0).collect()
    assert len(got) == 15 * 20
    assert max(abs(x.score - float(v[x.query_id] @ v[x.vec_id])) for x in got) < 1e-13
