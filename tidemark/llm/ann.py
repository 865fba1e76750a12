"""Approximate nearest neighbours over balanced posting lists.

Largest inner product is turned into smallest distance by one more coordinate
that gives every vector the same length.  A bounded sample fits the centroids
by balanced splits; every vector is posted to its nearest centroid's list and,
near a boundary, to further ones.  A query walks a neighbour graph of the
centroids held in memory and keeps the lists whose distance is within a ratio
of the best; the ratio is the one at which a bounded sample of queries, searched
exactly, finds ``RECALL`` of its neighbours.  Queries and lists then meet in
groups of bounded size, where exact inner products decide.

The walk visits a share of the lists that depends on the data: few where
vectors cluster, more than half where they point in all directions evenly.

Equal vectors are searched once: a result can name no more than the smallest
few ids of a vector, so a hot vector costs no more than any other.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, unaligned

NEAREST = 20
SAMPLE_ROWS = 20_000        # vectors that fit the centroids, at most about
SAMPLE_QUERIES = 256        # queries that fit the ratio, at most
RECALL = 0.98               # that the ratio gives them
LIST_SIZE = 512             # vectors a list is meant to hold
MAX_LISTS = 4096
ROUNDS = 6                  # of centroid refinement
REPLICAS = 4                # lists a vector is posted to, at most
REPLICA_RATIO = 1.02        # of its distance to the nearest centroid
MIN_PROBES = 4
DEGREE = 16
WALK_SLACK = 1.03           # the walk looks a little beyond the ratio
GROUP_VECTORS, GROUP_QUERIES = 8192, 2048
SEED = 5


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``: rows with an id whose vector is not null, not zero and all
    finite.  An id on several rows counts once, with its smallest vector."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x) == F.lit(float("inf")).cast("float")))
    ok = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(
        ~bad & F.exists(v, lambda x: x != 0))
    return ok.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(v).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _combined(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


@dataclass
class Index:
    centroids: np.ndarray       # of the lengthened vectors
    graph: list[np.ndarray]     # neighbours of each centroid
    entries: np.ndarray         # where a walk may begin
    top: float                  # the largest squared length of a vector
    ratio: float = 1.0          # lists up to this many times the best distance are searched

    def lengthen(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.top - np.einsum("ij,ij->i", x, x)))
        return np.hstack([x, rest[:, None]])

    def posts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and list of every posting of ``x``."""
        x = self.lengthen(x)
        c = self.centroids
        d = np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T))
        k = min(REPLICAS, len(c))
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        dist = np.take_along_axis(d, near, 1)
        keep = dist <= dist.min(1, keepdims=True) * REPLICA_RATIO + 1e-12
        row, slot = np.nonzero(keep)
        return row, near[row, slot]

    def _far(self, q: np.ndarray):
        """The distance of centroids from a query."""
        q = np.append(q / np.sqrt(q @ q) * np.sqrt(self.top), 0.0)

        def far(nodes):
            gap = self.centroids[nodes] - q
            return np.sqrt(np.einsum("ij,ij->i", gap, gap))

        return far

    def needed_ratio(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The ratio at which the list of each row of ``x`` is searched for ``q``."""
        d = self._far(q)(np.arange(len(self.centroids)))
        row, to = self.posts(x)
        out = np.full(len(x), np.inf)
        np.minimum.at(out, row, d[to])
        return out / max(d.min(), 1e-300)

    def probes(self, q: np.ndarray, held: dict[int, int] | None = None,
               least: int = 0) -> list[int]:
        """Lists to search for one query: best-first walk of the graph, then pruning
        by the ratio to the best distance.  Where the lists ``held`` fewer than
        ``least`` vectors, the next nearest lists are added."""
        far = self._far(q)
        start = far(self.entries)
        order = np.argsort(start, kind="stable")[:4]
        found = {int(self.entries[i]): float(start[i]) for i in order}
        todo = [(d, n) for n, d in found.items()]
        heapq.heapify(todo)
        best, popped = todo[0][0], 0
        while todo:
            d, node = heapq.heappop(todo)
            popped += 1
            if d > best * self.ratio * WALK_SLACK and popped > 4 * MIN_PROBES:
                break
            new = [n for n in self.graph[node].tolist() if n not in found]
            for dn, n in zip(far(new).tolist() if new else (), new):
                found[n] = dn
                heapq.heappush(todo, (dn, n))
                best = min(best, dn)
        near = sorted((d, n) for n, d in found.items())
        picked = [n for i, (d, n) in enumerate(near) if d <= best * self.ratio or i < MIN_PROBES]
        short = least - sum(held.get(n, 0) for n in picked) if held is not None else 0
        if short > 0:
            chosen = set(picked)
            for n in np.argsort(far(np.arange(len(self.centroids))), kind="stable").tolist():
                if short > 0 and n not in chosen:
                    picked.append(n)
                    short -= held.get(n, 0)
        return picked


def build_index(sample: np.ndarray, lists: int, top: float) -> Index:
    """Centroids by repeated even splits of the sample, and their neighbour graph."""
    draw = np.random.default_rng(SEED)
    index = Index(np.empty(0), [], np.empty(0), top)
    x = index.lengthen(sample)
    parts = [np.arange(len(x))]
    while len(parts) < lists and max(map(len, parts)) > 1:
        parts.sort(key=len, reverse=True)       # the largest part is split in halves
        rows = parts.pop(0)
        a, b = x[draw.choice(rows, 2, replace=False)]
        for _ in range(4):                      # two means, then an even cut between them
            side = (x[rows] @ (b - a)) > (b @ b - a @ a) / 2
            if side.all() or not side.any():
                break
            a, b = x[rows[~side]].mean(0), x[rows[side]].mean(0)
        order = np.argsort(x[rows] @ (b - a), kind="stable")
        half = len(rows) // 2
        parts += [rows[order[:half]], rows[order[half:]]]
    c = np.array([x[p].mean(0) for p in parts])
    for _ in range(ROUNDS):
        to = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        held = np.bincount(to, minlength=len(c))
        for j in range(x.shape[1]):
            c[:, j] = np.where(held > 0, np.bincount(to, x[:, j], len(c)) / np.maximum(held, 1),
                               c[:, j])
    d = (c * c).sum(1)[:, None] + (c * c).sum(1) - 2 * c @ c.T
    np.fill_diagonal(d, np.inf)
    k = min(DEGREE, len(c) - 1)
    near = np.argsort(d, axis=1, kind="stable")[:, :k] if k else np.zeros((len(c), 0), int)
    # Links go both ways, or a centroid that lies apart would be nobody's neighbour;
    # a walk begins at centroids that are as far apart as possible.
    links = [set(row) for row in near.tolist()]
    for node, row in enumerate(near.tolist()):
        for other in row:
            links[other].add(node)
    apart, entries = np.full(len(c), np.inf), [0]
    while len(entries) < min(len(c), 2 * int(np.sqrt(len(c))) + 2):
        apart = np.minimum(apart, ((c - c[entries[-1]]) ** 2).sum(1))
        entries.append(int(np.argmax(apart)))
    index.centroids, index.graph = c, [np.array(sorted(row), int) for row in links]
    index.entries = np.array(sorted(set(entries)))
    return index


def _calibrate(unique: DataFrame, index: Index, width: int, k: int) -> float:
    """The ratio at which sampled queries find ``RECALL`` of their exact neighbours."""
    spark = unique.sparkSession
    asked = _matrix(_combined(unique.orderBy(F.xxhash64("uid", F.lit(SEED + 1)), "uid")
                              .limit(SAMPLE_QUERIES).select("v").toArrow().column("v")), width)
    shared = spark.sparkContext.broadcast((index, asked))

    def scan(batches):
        built, q = shared.value
        best = [(np.empty(0), np.empty((0, width)))] * len(q)
        for b in batches:
            v = _matrix(b.column(0), width)
            scores = q @ v.T
            for i, own in enumerate(scores):
                some = np.argsort(-own, kind="stable")[:k + 1]
                s = np.concatenate([best[i][0], own[some]])
                x = np.vstack([best[i][1], v[some]])
                order = np.argsort(-s, kind="stable")[:k + 1]
                best[i] = s[order], x[order]
        rows = [(i, s, r) for i, (score, x) in enumerate(best) if len(x)
                for s, r in zip(score.tolist(), built.needed_ratio(q[i], x).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3,
                                            (pa.int32(), pa.float64(), pa.float64()))],
            ["at", "score", "ratio"])

    nth = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "ratio"))
    needed = unique.select("v").mapInArrow(scan, "at int, score double, ratio double") \
        .withColumn("nth", nth).where(F.col("nth").between(2, k + 1)).select("ratio").collect()
    # The first of each is the sampled vector itself.
    return float(np.quantile([r.ratio for r in needed] or [1.0], RECALL)) * (1 + 1e-9)


def _deal(posted: dict[int, int], probing: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """``(list, group, v_n, q_n)``: a large list takes ``v_n`` groups from ``group``
    on, small lists share one; the queries of a group are dealt into ``q_n`` parts."""
    spans, group, room = {}, -1, 0
    for name in sorted(posted):
        n = posted[name]
        if n > GROUP_VECTORS:
            parts = -(-n // GROUP_VECTORS)
            spans[name], group, room = (group + 1, parts), group + parts, 0
        else:
            if n > room:
                group, room = group + 1, GROUP_VECTORS
            spans[name], room = (group, 1), room - n
    load: dict[int, int] = {}
    for name, (g, _) in spans.items():
        load[g] = load.get(g, 0) + probing.get(name, 0)
    return [(name, g, parts, max(1, -(-load[g] // GROUP_QUERIES)))
            for name, (g, parts) in spans.items()]


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST,
            lists: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row of
    ``vectors(vec_id, embedding)`` for which ``is_query`` (an expression of
    ``vec_id``) holds, among all rows but the query's own.

    See ``usable`` for rows that take no part; neither do vectors of another
    length than the commonest (of equally common ones, the shortest).  Ties go
    to the smaller id; fewer candidates than ``k`` are all returned; no usable
    vector gives no rows; further columns are ignored."""
    spark = vectors.sparkSession
    rows = staged(usable(vectors), "ann-rows")
    result = "query_id long, rank int, vec_id long, score double"
    kinds = rows.groupBy(F.size("v").alias("width")).agg(
        F.count("*").alias("n"), F.max(F.aggregate(
            "v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("top"))
    kind = kinds.orderBy(F.desc("n"), "width").first()
    if kind is None:
        return spark.createDataFrame([], result)
    width, top = kind.width, float(kind.top)
    rows = rows.where(F.size("v") == width)

    # The smallest k + 1 ids of each distinct vector; the limit works before the shuffle.
    some = rows.withColumn("nth", F.row_number().over(
        Window.partitionBy("v").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    unique = staged(some.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                    .select(F.col("ids")[0].alias("uid"), "ids", "v"), "ann-unique")
    asked = staged(rows.where(is_query).join(unique.select("uid", "v"), "v")
                   .select(F.col("vec_id").alias("query_id"), "uid"), "ann-queries")
    queries = unique.select("uid", "v").join(asked.select("uid").distinct(), "uid", "left_semi")

    n = unique.count()
    grain = 1 << 30
    share = min(1.0, SAMPLE_ROWS / n)
    sample = unique.where(F.pmod(F.xxhash64("uid", F.lit(SEED)), F.lit(grain))
                          <= int(share * grain)).orderBy("uid").select("v").toArrow()
    if not sample.num_rows:
        sample = unique.orderBy("uid").limit(1).select("v").toArrow()
    index = build_index(_matrix(_combined(sample.column("v")), width),
                        lists or max(1, min(MAX_LISTS, n // LIST_SIZE)), top)
    index.ratio = _calibrate(unique, index, width, k)
    shared = spark.sparkContext.broadcast(index)    # at most MAX_LISTS centroids

    def post(batches):
        for b in batches:
            row, to = shared.value.posts(_matrix(b.column(1), width))
            once = np.diff(row, prepend=-1) != 0        # one posting of each vector
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), b.column(0).take(pa.array(row)),
                 b.column(1).take(pa.array(row)), pa.array(once)], ["list", "uid", "v", "once"])

    def probe(batches):
        for b in batches:
            found = [shared.value.probes(q, held.value, k + 1)
                     for q in _matrix(b.column(1), width)]
            row = pa.array(np.repeat(np.arange(len(found)), list(map(len, found))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for f in found for n in f], pa.int32()), b.column(0).take(row),
                 b.column(1).take(row)], ["list", "uid", "v"])

    # Scores are those of the vectors as they came: doubles stay doubles.
    number = "float" if rows.schema["v"].dataType.elementType.typeName() == "float" else "double"
    schema = f"list int, uid long, v array<{number}>"
    posted = staged(unique.select("uid", F.col("v").cast(f"array<{number}>")).mapInArrow(
        post, schema + ", once boolean"), "ann-lists")
    # A vector counts in one of its lists, so lists together hold no fewer than this.
    counted = posted.groupBy("list").agg(
        F.count("*"), F.sum(F.col("once").cast("int"))).collect()
    held = spark.sparkContext.broadcast({r[0]: r[2] for r in counted})
    probing = staged(queries.select("uid", F.col("v").cast(f"array<{number}>")).mapInArrow(
        probe, schema), "ann-probes")
    # Lists and their queries are dealt into groups of bounded size.  The plan
    # has one row per list, MAX_LISTS at most, so it may be broadcast.
    sizes = [{r[0]: r[1] for r in counted}, dict(probing.groupBy("list").count().collect())]
    plan = F.broadcast(spark.createDataFrame(_deal(*sizes), "list int, g int, v_n int, q_n int"))
    part = {n: F.pmod(F.xxhash64("uid", F.lit(SEED)), F.col(n)).cast("int")
            for n in ("v_n", "q_n")}

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = posted.join(plan, "list").select(
        (F.col("g") + part["v_n"]).alias("g"), every("q_n").alias("q_part"), "list", "uid", "v")
    right = probing.join(plan, "list").select(
        F.explode(F.sequence("g", F.col("g") + F.col("v_n") - 1)).alias("g"),
        part["q_n"].alias("q_part"), "list", "uid", "v")
    hit_schema = pa.schema([("quid", pa.int64()), ("uid", pa.int64()), ("score", pa.float64())])

    def search(vs: pa.Table, qs: pa.Table) -> pa.Table:
        if not vs.num_rows or not qs.num_rows:
            return hit_schema.empty_table()
        v, q = (_matrix(_combined(t.column("v")), width) for t in (vs, qs))
        (v_list, uid), (q_list, quid) = ([t.column(c).to_numpy() for c in ("list", "uid")]
                                         for t in (vs, qs))
        out = []
        for name in np.unique(q_list):
            own, ask = np.flatnonzero(v_list == name), np.flatnonzero(q_list == name)
            keep = min(k + 1, len(own))
            for at in range(0, len(ask) if keep else 0, 256):
                some = ask[at:at + 256]
                scores = q[some] @ v[own].T
                edge = np.partition(scores, len(own) - keep, axis=1)[:, len(own) - keep]
                r, c = np.nonzero(scores >= edge[:, None] - 1e-9 * np.abs(edge[:, None]))
                exact = (v[own[c]] * q[some[r]]).sum(1)
                out.append((quid[some[r]], uid[own[c]], exact))
        if not out:
            return hit_schema.empty_table()
        who, what, score = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((what, -score, who))
        who, what, score = who[order], what[order], score[order]
        new = np.append(True, (who[1:] != who[:-1]) | (what[1:] != what[:-1]))
        who, what, score = who[new], what[new], score[new]
        first = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        nth = np.arange(len(who)) - np.repeat(first, np.diff(np.append(first, len(who))))
        top_few = nth <= k
        return pa.table([who[top_few], what[top_few], score[top_few]], schema=hit_schema)

    keys = ["g", "q_part"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "quid long, uid long, score double")
    by_score = [F.desc("score"), F.asc("uid")]
    best = hits.groupBy("quid", "uid").agg(F.max("score").alias("score")).withColumn(
        "nth", F.row_number().over(Window.partitionBy("quid").orderBy(*by_score))) \
        .where(F.col("nth") <= k + 1).select("quid", "uid", "score")
    named = best.join(unique.select("uid", "ids"), "uid").select(
        "quid", (-F.col("score")).alias("less"), F.explode("ids").alias("vec_id")).select(
        "quid", F.struct("less", "vec_id").alias("hit"))
    top_ids = named.groupBy(unaligned(F.col("quid")).alias("uid")).agg(
        F.slice(F.sort_array(F.collect_list("hit")), 1, k + 1).alias("hits")).select(
        unaligned(F.col("uid")).alias("uid"), "hits")
    own = asked.join(top_ids, "uid").select("query_id", F.slice(F.filter(
        "hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k).alias("hits"))
    return own.select("query_id", F.posexplode("hits").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.less")).alias("score"))
