"""Stream = batch: each streaming operator, fed the sf0.001 data as several
shuffled files, gives the batch operator's result.  One closing record far
in the future moves the watermark past the end and is left out."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark import schemas as S
from tidemark.operators import logs, orders
from tidemark.plans import config as C
from tidemark.sources import projections as P
from tidemark.sources.tables import table
from tidemark.streaming import pipelines as SP

CLOSING_TS = 4 * 10 ** 12     # year 2096: closes every window / timer (pandas-safe)
HOUR = 3_600_000


def _write_files(df, path, n=5):
    """``df`` as ``n`` JSON files of consecutive time ranges, rows shuffled
    inside each file (out of order within a micro-batch)."""
    (df.repartitionByRange(n, "ts").withColumn("_r", F.rand(7))
       .sortWithinPartitions("_r").drop("_r")
       .write.mode("overwrite").json(path))
    # the file source reads oldest first: stamp modification times in range order
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    for i, f in enumerate(parts):
        os.utime(os.path.join(path, f), (1_000_000 + i, 1_000_000 + i))


def _closing(spark, df):
    """One record of ``df`` moved far into the future, for a visitor of its own."""
    return (df.limit(1).withColumn("event_id", F.lit(-1).cast("long"))
            .withColumn("ts", F.lit(CLOSING_TS).cast("long"))
            .withColumn("common", F.col("common").withField("mid", F.lit("zz"))))


def _run(query_df, path, name):
    q = (query_df.writeStream.format("parquet").option("path", os.path.join(path, name))
         .option("checkpointLocation", os.path.join(path, name + "_ckpt"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None, q.exception()
    return q


@pytest.fixture(scope="module")
def page_src(spark, tmp_path_factory):
    from tidemark.session import ensure_checkpoint_dir
    import tempfile
    base = tempfile.mkdtemp(prefix="stream-", dir=ensure_checkpoint_dir(spark))
    page = P.page_log(table(spark, SF001, "events"))
    _write_files(page.unionByName(_closing(spark, page)), os.path.join(base, "in"))
    return base, page


def _stream(spark, base, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .json(os.path.join(base, "in")))


@pytest.mark.parametrize("variant", [("entry", "both"), ("non_entry", "timeout")])
def test_bounce_stream_equals_batch(spark, page_src, variant):
    base, page = page_src
    name = "bounce_" + "_".join(variant)
    src = _stream(spark, base, page.schema)
    _run(SP.bounce_stream(src, 6 * HOUR, *variant), base, name)
    got = spark.read.parquet(os.path.join(base, name)).filter("event_id >= 0")
    want = logs.bounce_visits(page, 6 * HOUR, *variant)
    assert set(got.columns) == set(page.columns)        # whole records
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    assert want.count() > 0


def test_daily_uv_stream_equals_batch(spark, page_src):
    base, page = page_src
    src = _stream(spark, base, page.schema)
    _run(SP.daily_unique_visitors_stream(src, window_ms=6 * HOUR), base, "uv")
    got = spark.read.parquet(os.path.join(base, "uv")).filter("event_id >= 0")
    want = logs.daily_unique_visitors(page)
    assert set(got.columns) == {"mid", "visit_date", *page.columns}
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_flag_stream_equals_batch(spark, page_src):
    base, _ = page_src
    ev = table(spark, SF001, "events")
    log = P.app_log(ev)
    closing = _closing(spark, log)
    _write_files(log.unionByName(closing), os.path.join(base, "logs_in"))
    src = (spark.readStream.schema(S.APP_LOG).option("maxFilesPerTrigger", 1)
           .json(os.path.join(base, "logs_in")))
    _run(SP.flag_new_visitors_stream(src, window_ms=6 * HOUR), base, "flag")
    got = (spark.read.parquet(os.path.join(base, "flag")).filter("event_id >= 0")
           .select("event_id", F.col("common.is_new").alias("is_new")))
    want = logs.flag_new_visitors(log).select("event_id", F.col("common.is_new").alias("is_new"))
    assert got.count() == want.count() == 1000
    assert sorted(got.collect()) == sorted(want.collect())


def test_interval_join_stream_equals_batch(spark, page_src):
    base, _ = page_src
    info = orders.with_time_fields(P.order_info(table(spark, SF001, "orders")))
    detail = orders.with_time_fields(P.order_detail(table(spark, SF001, "lineitem")), False)
    band = C.ORDER_BAND_MS
    info.write.mode("overwrite").parquet(os.path.join(base, "oi"))
    detail.write.mode("overwrite").parquet(os.path.join(base, "od"))
    si = spark.readStream.schema(info.schema).parquet(os.path.join(base, "oi"))
    sd = spark.readStream.schema(detail.schema).parquet(os.path.join(base, "od"))
    _run(SP.order_interval_join_stream(si, sd, band, band, allowance_ms=10 ** 12), base, "ow")
    got = spark.read.parquet(os.path.join(base, "ow"))
    want = orders.interval_join(info, detail, band, band)
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_late_rows_dropped_counted_and_restart(spark, page_src):
    """Three runs on one checkpoint (a restart each time): a record whose
    window closed in an earlier batch is dropped and counted (W6), and the
    visitor state survives the restarts (W7/W8)."""
    import json
    from tidemark.streaming.jobs import rows_dropped_by_watermark
    base, page = page_src
    src_dir = os.path.join(base, "late_in")
    os.makedirs(src_dir)

    def rec(eid, mid, ts):
        return json.dumps({"event_id": eid, "common": {"mid": mid},
                           "page": {"page_id": "home"}, "ts": ts})

    def run_once(lines, i):
        with open(os.path.join(src_dir, f"f{i}.json"), "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(os.path.join(src_dir, f"f{i}.json"), (1_000_000 + i, 1_000_000 + i))
        src = spark.readStream.schema(page.schema).json(src_dir)
        q = (SP.daily_unique_visitors_stream(src, window_ms=5000).writeStream
             .format("parquet").option("path", os.path.join(base, "late_out"))
             .option("checkpointLocation", os.path.join(base, "late_ckpt"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None
        return q

    run_once([rec(1, "a", 10_000), rec(2, "b", 20_000)], 0)
    q = run_once([rec(3, "c", 1_000), rec(4, "a", 30_000)], 1)   # c is late
    dropped = rows_dropped_by_watermark(q, recent=True)
    run_once([rec(5, "zz", CLOSING_TS)], 2)
    got = sorted((r.mid, r.event_id) for r in
                 spark.read.parquet(os.path.join(base, "late_out")).filter("mid <> 'zz'").collect())
    assert got == [("a", 1), ("b", 2)]        # c dropped; a's second record same day
    assert dropped >= 1


def test_records_are_late_by_window(spark, page_src):
    """Allowance 3 s, window 5 s: with the clock at 9 s a record of 5.5 s still
    belongs to an open window and is kept; one of a closed window is dropped and
    counted."""
    import json
    from tidemark.streaming.jobs import rows_dropped_by_watermark
    base, page = page_src
    src_dir = os.path.join(base, "window_in")
    os.makedirs(src_dir)

    def run_once(i, *records):
        path = os.path.join(src_dir, f"f{i}.json")
        with open(path, "w") as f:
            f.writelines(json.dumps({"event_id": e, "common": {"mid": m}, "ts": t,
                                     "page": {"page_id": "home"}}) + "\n" for e, m, t in records)
        os.utime(path, (1_000_000 + i, 1_000_000 + i))
        src = spark.readStream.schema(page.schema).json(src_dir)
        return _run(SP.flag_new_visitors_stream(src, window_ms=5000), base, "window")

    run_once(0, (1, "a", 9_000), (6, None, 9_000))
    run_once(1, (2, "b", 5_500), (3, "c", 20_000))
    q = run_once(2, (4, "d", 1_000))
    assert rows_dropped_by_watermark(q, recent=True) == 1
    run_once(3, (5, "zz", CLOSING_TS))
    got = {r.event_id: r.common.is_new for r in spark.read.parquet(os.path.join(base, "window"))
           .filter("event_id <> 5").collect()}
    assert got == {1: "1", 2: "1", 3: "1", 6: "0"}


class _Handle:
    """A state handle in memory, for one key."""

    def __init__(self):
        self.values, self.timers = {}, []

    def getValueState(self, name, _schema):
        handle = self

        class Value:
            def exists(self):
                return name in handle.values

            def get(self):
                return handle.values[name]

            def update(self, v):
                handle.values[name] = v

            def clear(self):
                handle.values.pop(name, None)
        return Value()

    def registerTimer(self, at):
        self.timers.append(at)


class _Clock:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


def test_bounce_state_of_non_entry_pages_is_forgotten():
    from tidemark.streaming.processors import BounceProcessor
    p, h = BounceProcessor(5000), _Handle()
    p.init(h)
    for i in range(50):
        list(p.handleInputRows(("a",), iter([
            {"ts": i * 100, "event_id": i, "entry": False, "ok": True, "value": None}]), None))
    assert h.timers and "buf" in h.values
    while h.timers:
        at = max(h.timers)
        h.timers.clear()
        list(p.handleExpiredTimer(("a",), _Clock(max(at, 5000)), None))
    assert not h.values
