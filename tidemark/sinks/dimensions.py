"""Dimension store: rule-defined tables kept by upsert.

Layout per table (upper-case name), parquet, all-text columns, key first:

* ``<base>/<TABLE>/base/v=<n>/`` — complete snapshots; ``v=0`` is the empty
  table created from the rule (S6).
* ``<base>/<TABLE>/delta/b=<batch>/`` — one row per key of one micro-batch.
  The cost of a batch is the batch, not the table; a batch without rows of a
  table writes nothing, and a replayed batch is skipped.

Snapshots and deltas are cut into hash buckets of the key, by their size: folders
``_bucket=<number of buckets>_<bucket>``.  ``lookup`` reads only the buckets that the
keys it is asked for fall into, so enriching a micro-batch costs the batch.

When the deltas have grown to ``compact_ratio`` of the snapshot, or are more
than ``max_deltas``, they are folded into a new snapshot ``v=<batch + 1>``;
snapshots before the last two, and the deltas these cover, are deleted (a
reader may still be on the snapshot before the newest).

``read`` gives, per key and column, the newest value (last write wins): a
change that does not carry a column leaves it as it was, and a column that a
rule added later is ``''`` in older rows.  Among changes of one instant the
later batch wins.  A folder only counts once its ``_SUCCESS`` marker exists.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dims
from tidemark.sinks import fs

_V = re.compile(r"^v=(\d+)$")
_B = re.compile(r"^b=(\d+)$")
_ORDER = ("_seq", "_batch")
_BUCKET = "_bucket"
MAX_BUCKETS = 4096          # a power of two
BUCKET_ROWS = 100_000       # rows of a bucket, about


class DimensionStore:
    def __init__(self, spark: SparkSession, base_path: str, compact_ratio: float = 0.5,
                 max_deltas: int = 20, bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.base = base_path.rstrip("/")
        self.compact_ratio = float(compact_ratio)
        self.max_deltas = max(1, int(max_deltas))
        self.bucket_rows = max(1, int(bucket_rows))

    # layout --------------------------------------------------------------------
    def _dir(self, table: str, kind: str) -> str:
        return f"{self.base}/{table.upper()}/{kind}"

    def _complete(self, folder: str, pattern) -> list[int]:
        return sorted(int(m.group(1)) for name in fs.list_names(self.spark, folder)
                      if (m := pattern.match(name))
                      and fs.exists(self.spark, f"{folder}/{name}/_SUCCESS"))

    def versions(self, table: str) -> list[int]:
        return self._complete(self._dir(table, "base"), _V)

    def deltas(self, table: str) -> list[int]:
        return self._complete(self._dir(table, "delta"), _B)

    # S6 -------------------------------------------------------------------------
    def create_if_absent(self, table: str, sink_columns: str, sink_pk: str | None = None) -> None:
        """Empty snapshot ``v=0`` with the rule's all-text schema."""
        if self.versions(table):
            return
        schema = dims.table_schema(sink_columns, sink_pk)
        (self.spark.createDataFrame([], schema)
         .withColumns({c: F.lit(None).cast("long") for c in _ORDER})
         .write.mode("overwrite").parquet(f"{self._dir(table, 'base')}/v=0"))

    # buckets --------------------------------------------------------------------
    @staticmethod
    def _same(key: str) -> Column:
        """Keys are text; facts name them by number, so ``007`` and ``7`` are one."""
        return F.coalesce(F.col(key).try_cast("bigint").cast("string"), F.col(key))

    def _slot(self, key: str) -> Column:
        return F.pmod(F.xxhash64(self._same(key)), F.lit(MAX_BUCKETS))

    def _write(self, rows: DataFrame, path: str) -> None:
        """``rows``, keyed by their first column, in as many buckets as their number asks for."""
        rows = rows.persist()       # counted, then written
        try:
            n, buckets = rows.count(), 1
            while buckets < MAX_BUCKETS and buckets * self.bucket_rows < n:
                buckets *= 2
            bucket = F.pmod(self._slot(rows.columns[0]), F.lit(buckets))
            (rows.withColumn(_BUCKET, F.concat(F.lit(f"{buckets}_"), bucket.cast("string")))
             .repartition(buckets, _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(path))
        finally:
            rows.unpersist()

    def _load(self, paths: list[str], touched: list[int] | None) -> DataFrame:
        sizes = [1 << i for i in range(MAX_BUCKETS.bit_length())]
        names = sorted({f"{n}_{t % n}" for n in sizes for t in touched or []})

        def one(path: str) -> DataFrame:
            rows = self.spark.read.parquet(path)
            if _BUCKET in rows.columns and touched is not None:
                rows = rows.where(F.col(_BUCKET).isin(names))
            return rows.drop(_BUCKET)

        # Rules change: folders may have columns that others lack.
        return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), map(one, paths))

    # reads ----------------------------------------------------------------------
    def read(self, table: str) -> DataFrame | None:
        """Current content of a table (without the order columns)."""
        raw = self._current(table)
        return None if raw is None else raw.drop(*_ORDER).na.fill("")

    def lookup(self, table: str, keys: DataFrame) -> DataFrame | None:
        """Current rows of the keys in the one column of ``keys`` (as text), read from the
        buckets they fall into."""
        wanted = keys.select(F.col(keys.columns[0]).cast("string").alias("key")).where(
            "key is not null").select(self._same("key").alias("key")).distinct()
        # At most ``MAX_BUCKETS`` numbers.
        touched = [r.b for r in wanted.select(self._slot("key").alias("b")).distinct().collect()]
        raw = self._current(table, touched=touched)
        if raw is None:
            return None
        current = raw.drop(*_ORDER).na.fill("")
        return current.join(wanted, self._same(current.columns[0]) == wanted["key"], "left_semi")

    def _current(self, table: str, upto: int | None = None,
                 touched: list[int] | None = None) -> DataFrame | None:
        vs = self.versions(table)
        if upto is not None:          # compaction at batch `upto`: strictly older snapshots
            vs = [v for v in vs if v <= upto]
        if not vs:
            return None
        v = vs[-1]
        base = self._load([f"{self._dir(table, 'base')}/v={v}"], touched)
        newer = [b for b in self.deltas(table) if b + 1 > v and (upto is None or b <= upto)]
        if not newer:
            return base
        delta = self._load([f"{self._dir(table, 'delta')}/b={b}" for b in newer], touched)
        both = base.unionByName(delta, allowMissingColumns=True)
        return dims.latest_per_column(both, base.columns[0], *_ORDER).select(*[
            c for c in both.columns if c not in _ORDER], *_ORDER)

    # S5 -------------------------------------------------------------------------
    def upsert(self, rows: DataFrame, batch_id: int,
               tables: dict[str, tuple[str, str | None]]) -> None:
        """``rows``: ``(sink_table, pk, seq, pos, data)`` from ``dims.dimension_rows``;
        ``tables``: sink table -> (columns, key) of the rules in force
        (``dims.union_rules``)."""
        batch_id = int(batch_id)
        if "pos" not in rows.columns:
            rows = rows.withColumn("pos", F.monotonically_increasing_id())
        for t, (columns, pk) in tables.items():
            self.create_if_absent(t, columns, pk)
        # One small row per sink table of the rules.
        touched = {r.sink_table for r in rows.select("sink_table").distinct().collect()}
        for t, (columns, pk) in tables.items():
            if t not in touched or batch_id in self.deltas(t) or self.versions(t)[-1] > batch_id:
                continue
            names = [f.name for f in dims.table_schema(columns, pk).fields]
            carried = rows.filter((F.col("sink_table") == t) & F.col("pk").isNotNull()).select(
                *[F.col("data")[c].alias(c) for c in names], "seq", "pos")
            self._write(dims.latest_per_column(carried, names[0], "seq", "pos").select(
                *names, F.col("seq").alias("_seq"), F.lit(batch_id).cast("long").alias("_batch")),
                f"{self._dir(t, 'delta')}/b={batch_id}")
            if self._due(t):
                self.compact(t, batch_id)

    def _due(self, table: str) -> bool:
        v = self.versions(table)[-1]
        newer = [b for b in self.deltas(table) if b + 1 > v]
        grown = sum(fs.size(self.spark, f"{self._dir(table, 'delta')}/b={b}") for b in newer)
        base = fs.size(self.spark, f"{self._dir(table, 'base')}/v={v}")
        return len(newer) > self.max_deltas or (
            len(newer) > 1 and grown >= self.compact_ratio * base)

    def compact(self, table: str, batch_id: int) -> None:
        """Fold the deltas up to ``batch_id`` into snapshot ``v=batch_id + 1``."""
        cur = self._current(table, upto=batch_id)
        if cur is not None and batch_id + 1 not in self.versions(table):
            self._write(cur, f"{self._dir(table, 'base')}/v={batch_id + 1}")
            self.vacuum(table)

    def vacuum(self, table: str) -> None:
        """Delete what the last two snapshots no longer need."""
        vs = self.versions(table)
        if len(vs) < 2:
            return
        for v in vs[:-2]:
            fs.remove(self.spark, f"{self._dir(table, 'base')}/v={v}")
        for b in self.deltas(table):
            if b + 1 <= vs[-2]:
                fs.remove(self.spark, f"{self._dir(table, 'delta')}/b={b}")
