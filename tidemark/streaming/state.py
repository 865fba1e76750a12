"""State of the batch-wise streaming jobs as tables in the shared folder.

A job that runs DataFrame operators in ``foreachBatch`` keeps what later batches need
in a ``BatchState``: small tables that every batch replaces (``held``), key sets that
only grow (``seen``) and numbers (the watermark).  Batch ``n`` reads the newest state
before ``n`` and writes state ``n``, which counts once its manifest exists; a replayed
batch therefore sees what it saw the first time.

What a batch takes more than once is staged (``stage``): a table in the shared folder
that goes with the batch.  Unlike a persisted frame it takes no executor memory, is
read by columns, and no executor must serve its blocks to others.

Key sets are kept in segments.  A segment is cut into hash buckets by its size, and a
look-up reads only the buckets that its keys fall into.  Segments of one size class
are folded together, so there are few of them and a key is rewritten a logarithmic
number of times.  Keys may expire.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks import fs

KEPT_STATES = 2             # the newest, and the one a replay of it reads
BUCKET_ROWS = 100_000       # keys of a bucket, about
MAX_BUCKETS = 4096
FOLD = 4                    # segments of one size class that become one
ROW_GROUP = 16 * 1024 * 1024    # of staged tables: about what a task holds as it writes
KEY_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                           T.StructField("until", T.LongType())])


class BatchState:
    def __init__(self, spark: SparkSession, root: str, max_buckets: int = MAX_BUCKETS,
                 bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.max_buckets = max_buckets
        self.bucket_rows = bucket_rows
        self._made: list[str] = []          # segments of the batch at work

    # manifests ------------------------------------------------------------------
    def _manifest(self, batch_id: int) -> str:
        return f"{self.root}/batch={batch_id}.json"

    def _ids(self) -> list[int]:
        return sorted(int(n[6:-5]) for n in fs.list_names(self.spark, self.root)
                      if n.startswith("batch=") and n.endswith(".json"))

    def before(self, batch_id: int) -> dict:
        """The newest state before a batch: ``values``, ``held`` and ``seen``."""
        ids = [i for i in self._ids() if i < batch_id]
        if not ids:
            return {"values": {}, "held": {}, "seen": []}
        return json.loads(fs.read_text(self.spark, self._manifest(ids[-1])))

    # tables ---------------------------------------------------------------------
    def held(self, state: dict, name: str, schema: T.StructType) -> DataFrame:
        """A held table of a state; empty where it has none."""
        if name not in state["held"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{state['held'][name]}")

    def write(self, batch_id: int, before: dict, held: dict[str, DataFrame],
              values: dict, new_keys: DataFrame | None = None, now: int | None = None) -> None:
        """State ``batch_id``: the held tables, values, and the keys of ``before`` with
        ``new_keys(key, until)``; keys whose ``until`` is not above ``now`` may go."""
        out = {"values": values, "held": {}, "seen": list(before["seen"])}
        self._made = []
        for name, df in held.items():
            path = f"held/{name}/batch={batch_id}"
            df.write.mode("overwrite").parquet(f"{self.root}/{path}")
            out["held"][name] = path
        if new_keys is not None:
            out["seen"] = self._fold([*out["seen"], self._segment(new_keys, f"{batch_id}")],
                                     batch_id, now)
        out["seen"] = [s for s in out["seen"] if s["rows"] and not (
            now is not None and s["until"] is not None and s["until"] <= now)]
        fs.write_text(self.spark, self._manifest(batch_id), json.dumps(out))
        for path in set(self._made) - {s["path"] for s in out["seen"]}:
            fs.remove(self.spark, f"{self.root}/{path}")        # folded at once
        self._vacuum()

    # work tables ------------------------------------------------------------------
    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` computed once, as a table that is there until ``drop_staged``.  What a
        batch that was broken off has left under the name is replaced."""
        path = f"{self.root}/work/{name}"
        df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_staged(self) -> None:
        fs.remove(self.spark, f"{self.root}/work")

    # key sets -------------------------------------------------------------------
    def _hash(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.max_buckets))

    def _segment(self, keys: DataFrame, name: str) -> dict:
        path = f"seen/s={name}"
        rows, until, forever = keys.agg(F.count("*"), F.max("until"), F.count_if(
            F.col("until").isNull())).first()
        self._made.append(path)
        buckets = 1
        while buckets < self.max_buckets and buckets * self.bucket_rows < rows:
            buckets *= 2
        if rows:
            (keys.select("key", "until", F.pmod(self._hash(), F.lit(buckets)).alias("bucket"))
             .repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket")
             .parquet(f"{self.root}/{path}"))
        return {"path": path, "rows": rows, "buckets": buckets,
                "until": None if forever else until}

    def _fold(self, segments: list[dict], batch_id: int, now: int | None) -> list[dict]:
        size = lambda s: int(math.log(max(s["rows"], 1), FOLD))
        segments = [s for s in segments if s["rows"]]
        n = 0
        while len(segments) >= FOLD and size(segments[-FOLD]) <= size(segments[-1]) + 1:
            last, segments = segments[-FOLD:], segments[:-FOLD]
            keys = self._read(last)
            if now is not None:
                keys = keys.where(F.col("until").isNull() | (F.col("until") > now))
            n += 1
            segments.append(self._segment(keys, f"{batch_id}-{n}"))
        return segments

    def _read(self, segments: list[dict], touched: list[int] | None = None) -> DataFrame:
        out = self.spark.createDataFrame([], KEY_SCHEMA)
        for s in segments:
            one = self.spark.read.schema("key string, until long, bucket int").parquet(
                f"{self.root}/{s['path']}")
            if touched is not None and s["buckets"] > 1:
                one = one.where(F.col("bucket").isin(sorted({t % s["buckets"] for t in touched})))
            out = out.unionByName(one.select("key", "until"))
        return out

    def lookup(self, state: dict, keys: DataFrame) -> DataFrame:
        """``(key)`` of the seen keys in the buckets that ``keys(key)`` fall into."""
        segments = state["seen"]
        touched = None
        if any(s["buckets"] > 1 for s in segments):
            # At most ``max_buckets`` numbers.
            touched = [r.b for r in keys.select(self._hash().alias("b")).distinct().collect()]
        return self._read(segments, touched).select("key")

    # clean-up -------------------------------------------------------------------
    def _vacuum(self) -> None:
        """Delete the states before the last ones, and what only they name."""
        ids = self._ids()
        kept = [json.loads(fs.read_text(self.spark, self._manifest(i))) for i in ids[-KEPT_STATES:]]
        used = {p for m in kept for p in [*m["held"].values(), *(s["path"] for s in m["seen"])]}
        for i in ids[:-KEPT_STATES]:
            old = json.loads(fs.read_text(self.spark, self._manifest(i)))
            for path in [*old["held"].values(), *(s["path"] for s in old["seen"])]:
                if path not in used:
                    fs.remove(self.spark, f"{self.root}/{path}")
            fs.remove(self.spark, self._manifest(i))
