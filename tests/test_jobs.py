"""End-to-end streaming jobs over file topics built from sf0.001, checked
against the batch queries."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark import schemas as S
from tidemark.operators import cdc, dims, logs, orders
from tidemark.plans import config as C
from tidemark.plans import queries as Q
from tidemark.session import ensure_checkpoint_dir
from tidemark.sinks.dimensions import DimensionStore
from tidemark.sinks.topics import write_topic
from tidemark.sources import projections as P
from tidemark.sources.tables import table
from tidemark.sources.topics import TopicConfig, read_topic
from tidemark.streaming import jobs

ONCE = {"availableNow": True}
HOUR = 3_600_000


@pytest.fixture()
def env(spark):
    base = tempfile.mkdtemp(prefix="jobs-", dir=ensure_checkpoint_dir(spark))
    cfg = TopicConfig(base_path=os.path.join(base, "topics"), max_files_per_trigger=1)
    return base, cfg


def _stamp_in_order(path):
    """The file source reads oldest first: stamp modification times in
    (batch, part) order so event time and arrival order agree."""
    files = []
    for root, _, names in os.walk(path):
        files += [os.path.join(root, n) for n in names if n.startswith("part-")]
    for i, f in enumerate(sorted(files)):
        os.utime(f, (1_000_000 + i, 1_000_000 + i))


def _finish(queries):
    for q in queries:
        q.awaitTermination(600)
        assert q.exception() is None, q.exception()


def test_db_detail_job(spark, env):
    base, cfg = env
    text = P.change_log_text(table(spark, SF001, "customer"), table(spark, SF001, "part"))
    write_topic(text, cfg, S.TOPIC_ODS_DB, batch_id=0)
    rules_path = os.path.join(base, "rules")
    C.rule_history(spark).write.parquet(rules_path)
    dims_path = os.path.join(base, "dims")
    _finish(jobs.db_detail_job(spark, cfg, rules_path, dims_path, trigger=ONCE, state_root=os.path.join(base, "state")))

    want = Q.rule_route(spark, SF001)
    kafka = read_topic(spark, cfg, "dwd_part", streaming=False)
    assert kafka.count() == want.filter("sink_type = 'kafka'").count() > 0
    one = kafka.select(F.from_json("value", "map<string,string>").alias("m")).first().m
    assert set(one) == {"p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"}

    metrics = spark.read.json(cfg.path("db_detail_metrics"))
    by_branch = {r.branch: r["count"] for r in metrics.collect()}
    assert by_branch["kafka"] == kafka.count() and by_branch["hbase"] > 0

    store = DimensionStore(spark, dims_path)
    got = store.read("dim_user_info")
    assert got.columns == ["C_CUSTKEY", "C_NAME", "C_NATIONKEY", "C_MKTSEGMENT"]
    exp = (Q.dim_upsert_latest(spark, SF001).groupBy("pk")
           .agg(F.map_from_entries(F.collect_list(F.struct("col_name", "col_value"))).alias("m")))
    exp_rows = sorted((r.pk, r.m["C_NAME"], r.m["C_MKTSEGMENT"]) for r in exp.collect())
    got_rows = sorted((r.C_CUSTKEY, r.C_NAME, r.C_MKTSEGMENT) for r in got.collect())
    assert got_rows == exp_rows


ROWS = "sink_table string, pk string, seq long, pos long, data map<string,string>"


def test_dimension_store_deltas_and_compaction(spark, env):
    base, _ = env
    store = DimensionStore(spark, os.path.join(base, "dims2"), compact_ratio=100.0, max_deltas=2)
    tables = {"dim_x": ("id,name", "id"), "dim_idle": ("id", "id")}

    def rows(*r):
        return spark.createDataFrame([("dim_x", k, s, i, {"ID": k, "NAME": n})
                                      for i, (k, s, n) in enumerate(r)], ROWS)

    store.upsert(rows(("1", 1, "a"), ("2", 1, "b"), ("2", 0, "old"), ("4", 7, "x"), ("4", 7, "y")),
                 0, tables)
    b1 = rows(("1", 9, "z"), ("4", 7, "later batch"))
    store.upsert(b1, 1, tables)
    store.upsert(b1, 1, tables)                     # replay: skipped
    assert store.versions("dim_x") == [0] and store.deltas("dim_x") == [0, 1]
    assert store.versions("dim_idle") == [0] and store.deltas("dim_idle") == []
    want = [("1", "z"), ("2", "b"), ("4", "later batch")]
    assert sorted(tuple(r) for r in store.read("dim_x").collect()) == want
    store.upsert(rows(("3", 4, "c")), 2, tables)    # third delta: folded into v=3
    store.compact("dim_x", 2)                       # replayed compaction is harmless
    assert store.versions("dim_x") == [0, 3]
    want.insert(2, ("3", "c"))
    assert sorted(tuple(r) for r in store.read("dim_x").collect()) == want
    for b in range(3, 10):
        store.upsert(rows(("9", b, str(b))), b, tables)
    store.upsert(rows(("9", 99, "replayed")), 1, tables)        # long since folded
    assert len(store.versions("dim_x")) == 2 and min(store.deltas("dim_x")) >= 3
    assert sorted(tuple(r) for r in store.read("dim_x").collect()) == want + [("9", "9")]


def test_dimension_store_follows_rule_changes(spark, env):
    """A rule that gains a column between two batches, and two rules with
    different columns on one table."""
    base, _ = env
    store = DimensionStore(spark, os.path.join(base, "dims3"))

    def up(batch, columns, *r):
        frame = spark.createDataFrame([("d", k, s, i, data) for i, (k, s, data) in enumerate(r)], ROWS)
        store.upsert(frame, batch, {"d": (columns, "id")})

    up(0, "id,name", ("1", 1, {"ID": "1", "NAME": "a"}), ("2", 1, {"ID": "2", "NAME": "b"}))
    up(1, "id,name,city", ("1", 2, {"ID": "1", "NAME": "a2", "CITY": "c"}))
    up(2, "id,name,city", ("1", 3, {"ID": "1", "NAME": "a3"}))     # an update without the city
    want = [("1", "a3", "c"), ("2", "b", "")]
    assert sorted((r.ID, r.NAME, r.CITY) for r in store.read("d").collect()) == want
    store.compact("d", 2)
    assert sorted((r.ID, r.NAME, r.CITY) for r in store.read("d").collect()) == want


def test_lookups_read_only_the_buckets_of_their_keys(spark, env):
    base, _ = env
    store = DimensionStore(spark, os.path.join(base, "dims4"), max_deltas=2, bucket_rows=5)

    def up(batch, n, name):
        rows = spark.createDataFrame([("d", f"{k:03d}", batch, k, {"ID": f"{k:03d}", "NAME": name})
                                      for k in range(n)], ROWS)
        store.upsert(rows, batch, {"d": ("id,name", "id")})

    for batch, (n, name) in enumerate([(120, "a"), (40, "b"), (3, "c"), (2, "d"), (1, "e")]):
        up(batch, n, name)
        asked = spark.createDataFrame([(0,), (2,), (39,), (100,), (999,), (None,)], "k long")
        got = store.lookup("d", asked)
        newest = lambda k: next(x for m, x in reversed([(120, "a"), (40, "b"), (3, "c"), (2, "d"), (
            1, "e")][:batch + 1]) if k < m)
        assert sorted((r.ID, r.NAME) for r in got.collect()) == [
            (f"{k:03d}", newest(k)) for k in (0, 2, 39, 100)]
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1][:200]
    scanned = store._current("d", touched=[0]).count()
    assert 0 < scanned < 30 and store.read("d").count() == 120


def test_a_replayed_batch_keeps_its_rules(spark, env):
    base, _ = env
    rules, pins = os.path.join(base, "rules"), os.path.join(base, "pins")
    new = ("t", "insert", "kafka", "other_topic", "a", None, None, "update_after", 2, 0)
    old = ("t", "insert", "kafka", "topic", "a", None, None, "insert", 1, 0)
    spark.createDataFrame([old], S.RULE_CHANGE).write.parquet(rules)
    names = lambda b: [r.sink_table for r in jobs.pinned_rules(spark, rules, pins, b).collect()]
    assert names(0) == ["topic"]
    spark.createDataFrame([new], S.RULE_CHANGE).write.mode("append").parquet(rules)
    assert names(0) == ["topic"] and names(1) == ["other_topic"] and names(1) == ["other_topic"]


def test_records_of_a_bad_rule_are_held_back_alone(spark, env):
    base, cfg = env
    rules = [("good", "insert", "hbase", "dim_good", "id,n", "id", None, "insert", 1, 0),
             ("bad", "insert", "hbase", "dim_bad", "n", "id", None, "insert", 2, 0),
             ("top", "insert", "kafka", "dwd_top", "id", None, None, "insert", 3, 0)]
    spark.createDataFrame(rules, S.RULE_CHANGE).write.parquet(os.path.join(base, "rules"))
    text = spark.createDataFrame([(f'{{"database":"d","table":"{t}","type":"insert","ts":1,'
                                   f'"data":{{"id":"{i}","n":"name"}}}}',)
                                  for t in ("good", "bad", "top") for i in range(3)], "value string")
    write_topic(text, cfg, S.TOPIC_ODS_DB, batch_id=0)
    _finish(jobs.db_detail_job(spark, cfg, os.path.join(base, "rules"), os.path.join(base, "dims"),
                               trigger=ONCE, state_root=os.path.join(base, "state")))
    assert DimensionStore(spark, os.path.join(base, "dims")).read("dim_good").count() == 3
    assert read_topic(spark, cfg, "dwd_top", streaming=False).count() == 3
    held = read_topic(spark, cfg, S.TOPIC_ODS_DB + "_quarantine", streaming=False)
    assert [r.value.count('"source_table":"bad"') for r in held.collect()] == [1, 1, 1]


def test_a_replayed_batch_reaches_the_next_layer_once(spark, env):
    from tidemark.sinks.topics import write_addressed
    base, cfg = env
    rows = spark.range(5).selectExpr("cast(id as string) as value")

    def downstream():
        q = (read_topic(spark, cfg, "layer").writeStream.format("parquet")
             .option("path", os.path.join(base, "next")).option(
                 "checkpointLocation", os.path.join(base, "next_ckpt"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        return spark.read.parquet(os.path.join(base, "next")).count()

    write_topic(rows, cfg, "layer", 0)
    assert downstream() == 5
    write_topic(rows, cfg, "layer", 0)              # replay
    assert downstream() == 5
    named = rows.selectExpr("'layer' as topic_name", "map('k', value) as data")
    write_addressed(named, cfg, "topic_name", 1)
    write_addressed(named, cfg, "topic_name", 1)
    assert downstream() == 10


def test_jobs_need_a_shared_folder_and_the_state_store(spark, env):
    from tidemark.session import STATE_PROVIDER

    class Unset:
        class conf:
            @staticmethod
            def get(_key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        jobs.checkpoint_for(Unset, "job", "out")
    old = spark.conf.get(STATE_PROVIDER)
    spark.conf.unset(STATE_PROVIDER)
    try:
        with pytest.raises(ValueError, match="stateStore"):
            jobs.run_job(spark, "j", {}, lambda s: {}, {})
    finally:
        spark.conf.set(STATE_PROVIDER, old)


def test_log_detail_job_split(spark, env):
    base, cfg = env
    log = P.app_log(table(spark, SF001, "events"))
    closing = (log.limit(1).withColumn("event_id", F.lit(-1).cast("long"))
               .withColumn("ts", F.lit(4 * 10 ** 12).cast("long"))
               .withColumn("common", F.col("common").withField("mid", F.lit("zz"))))
    ordered = log.repartitionByRange(4, "ts").select(F.to_json(F.struct("*")).alias("value"))
    write_topic(ordered.unionByName(spark.createDataFrame([("{broken",)], "value string")),
                cfg, S.TOPIC_ODS_LOG, batch_id=0)
    write_topic(closing, cfg, S.TOPIC_ODS_LOG, batch_id=1)
    _stamp_in_order(cfg.path(S.TOPIC_ODS_LOG))
    _finish(jobs.log_detail_job(spark, cfg, window_ms=6 * HOUR, trigger=ONCE, state_root=os.path.join(base, "state")))

    def topic(t):
        return logs.parse_app_log(read_topic(spark, cfg, t, streaming=False))
    page = topic(S.TOPIC_DWD_PAGE).filter("event_id >= 0")
    want_page = Q.split_page(spark, SF001)
    got = sorted((r.event_id, r.common.is_new) for r in page.collect())
    assert got == sorted((r.event_id, r.is_new) for r in want_page.collect())
    assert topic(S.TOPIC_DWD_START).count() == Q.split_start(spark, SF001).count()
    disp = read_topic(spark, cfg, S.TOPIC_DWD_DISPLAYS, streaming=False)
    assert disp.count() == Q.split_displays(spark, SF001).count()
    bad = read_topic(spark, cfg, S.TOPIC_ODS_LOG + "_quarantine", streaming=False)
    assert [r.value for r in bad.collect()] == ["{broken"]


def test_order_wide_job(spark, env):
    base, cfg = env
    info = P.order_info(table(spark, SF001, "orders"))
    detail = P.order_detail(table(spark, SF001, "lineitem"))
    write_topic(info, cfg, S.TOPIC_DWD_ORDER_INFO, batch_id=0)
    write_topic(detail, cfg, S.TOPIC_DWD_ORDER_DETAIL, batch_id=0)
    dim_tables = Q._dims(spark, SF001)
    _finish(jobs.order_wide_job(spark, cfg, dim_tables, C.AS_OF, C.ORDER_BAND_MS,
                                C.ORDER_BAND_MS, allowance_ms=10 ** 12, trigger=ONCE, state_root=os.path.join(base, "state")))
    got = read_topic(spark, cfg, S.TOPIC_DWM_ORDER_WIDE, streaming=False)
    want = Q.order_wide(spark, SF001)
    parsed = got.select(F.from_json("value", want.schema).alias("r")).select("r.*")
    key = ["detail_id", "order_id", "user_age", "tm_name", "category3_name", "province_name"]
    assert sorted(parsed.select(*key).collect()) == sorted(want.select(*key).collect())


def test_raw_log_landing(spark, env):
    base, cfg = env
    incoming = os.path.join(base, "incoming")
    P.app_log_text(table(spark, SF001, "events")).write.text(incoming)
    landing = os.path.join(base, "landing")
    _finish(jobs.raw_log_landing_job(spark, cfg, incoming, landing, trigger=ONCE, state_root=os.path.join(base, "state")))
    landed = spark.read.text(landing)
    assert landed.count() == 1000
    days = landed.select("dt").distinct().count()
    assert days == table(spark, SF001, "events").select(F.to_date("ts")).distinct().count()
    assert read_topic(spark, cfg, S.TOPIC_ODS_LOG, streaming=False).count() == 1000


def test_dimension_path_feeds_order_wide(spark, env):
    """The reference's two paths together: change records of the six
    dimension tables -> db-detail job -> dimension store -> order-wide job
    (dimensions read per micro-batch) = the batch order_wide query."""
    base, cfg = env
    dim_frames = Q._dims(spark, SF001)
    changes, rules = None, []
    for i, (name, df) in enumerate(dim_frames.items()):
        src = name.lower().replace("dim_", "")
        cols = [c.lower() for c in df.columns]
        data = F.create_map(*[x for c in df.columns for x in (F.lit(c.lower()), F.col(c))])
        recs = df.select(F.lit("shop").alias("database"), F.lit(src).alias("table"),
                         F.lit("insert").alias("type"), F.lit(i).cast("long").alias("ts"),
                         data.alias("data"))
        changes = recs if changes is None else changes.unionByName(recs)
        rules.append((src, "insert", "hbase", name, ",".join(cols), "id", None, "insert", i + 1, 0))
    write_topic(changes, cfg, S.TOPIC_ODS_DB, batch_id=0)
    rules_path = os.path.join(base, "rules")
    spark.createDataFrame(rules, S.RULE_CHANGE).write.parquet(rules_path)
    store_path = os.path.join(base, "dims")
    _finish(jobs.db_detail_job(spark, cfg, rules_path, store_path, trigger=ONCE,
                               state_root=os.path.join(base, "state")))

    store = DimensionStore(spark, store_path)
    write_topic(P.order_info(table(spark, SF001, "orders")), cfg, S.TOPIC_DWD_ORDER_INFO, 0)
    write_topic(P.order_detail(table(spark, SF001, "lineitem")), cfg, S.TOPIC_DWD_ORDER_DETAIL, 0)
    _finish(jobs.order_wide_job(spark, cfg, jobs.dimension_reader(store), C.AS_OF,
                                C.ORDER_BAND_MS, C.ORDER_BAND_MS, allowance_ms=10 ** 12,
                                trigger=ONCE, state_root=os.path.join(base, "state")))
    want = Q.order_wide(spark, SF001)
    got = (read_topic(spark, cfg, S.TOPIC_DWM_ORDER_WIDE, streaming=False)
           .select(F.from_json("value", want.schema).alias("r")).select("r.*"))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=st.lists(st.lists(st.tuples(st.integers(1, 4), st.sampled_from("abc")),
                                 min_size=1, max_size=4), min_size=1, max_size=5))
def test_dimension_store_equals_last_write(spark, batches):
    import tempfile as _t
    from tidemark.session import ensure_checkpoint_dir
    store = DimensionStore(spark, _t.mkdtemp(prefix="dimprop-", dir=ensure_checkpoint_dir(spark)),
                           max_deltas=2)
    seq, last = 0, {}
    for b, rows in enumerate(batches):
        recs = []
        for pk, name in rows:
            seq += 1
            recs.append(("dim_p", str(pk), seq, seq, {"ID": str(pk), "NAME": name}))
            last[str(pk)] = name
        store.upsert(spark.createDataFrame(recs, ROWS), b, {"dim_p": ("id,name", "id")})
    got = {r.ID: r.NAME for r in store.read("dim_p").collect()}
    assert got == last


def test_layers_chain_through_topics(spark, env):
    """ods_log -> log-detail job -> dwd_page topic -> unique-visitor job ->
    dwm_uv topic, equal to the batch operators chained the same way."""
    base, cfg = env
    log = P.app_log(table(spark, SF001, "events"))
    closing = (log.limit(1).withColumn("event_id", F.lit(-1).cast("long"))
               .withColumn("ts", F.lit(4 * 10 ** 12).cast("long"))
               .withColumn("start", F.lit(None).cast(S.START))
               .withColumn("page", F.struct(F.lit("home").alias("page_id"),
                                            F.lit(None).cast("string").alias("last_page_id"),
                                            F.lit(0.0).alias("during_time")))
               .withColumn("common", F.col("common").withField("mid", F.lit("zz"))))
    write_topic(log.repartitionByRange(4, "ts").select(F.to_json(F.struct("*")).alias("value")),
                cfg, S.TOPIC_ODS_LOG, batch_id=0)
    write_topic(closing.select(F.to_json(F.struct("*")).alias("value")), cfg, S.TOPIC_ODS_LOG, 1)
    _stamp_in_order(cfg.path(S.TOPIC_ODS_LOG))
    state = os.path.join(base, "state")
    _finish(jobs.log_detail_job(spark, cfg, window_ms=6 * HOUR, trigger=ONCE, state_root=state))
    # the consumer takes every available file per batch, as from a live topic,
    # and a closing record moves its watermark past the end
    write_topic(closing, cfg, S.TOPIC_DWD_PAGE, batch_id=10 ** 6)
    _stamp_in_order(cfg.path(S.TOPIC_DWD_PAGE))
    cfg_all = TopicConfig(base_path=cfg.base_path)
    _finish(jobs.unique_visitor_job(spark, cfg_all, window_ms=6 * HOUR, trigger=ONCE,
                                    state_root=state))
    got = (read_topic(spark, cfg, S.TOPIC_DWM_UV, streaming=False)
           .select(F.from_json("value", S.APP_LOG).alias("r"))
           .select(F.col("r.common.mid").alias("mid"), "r.event_id").filter("mid <> 'zz'"))
    pages = logs.split_logs(logs.flag_new_visitors(log))["page"]
    want = logs.daily_unique_visitors(pages).select("mid", "event_id")
    assert sorted(got.collect()) == sorted(want.collect())
    assert want.count() > 0


def test_order_wide_job_keeps_no_row_wise_state(spark, env):
    """All orders and details pass through a batch join; late ones are counted."""
    base, cfg = env
    info, detail = P.order_info(table(spark, SF001, "orders")), P.order_detail(table(spark, SF001, "lineitem"))
    ran = []
    for i, part in enumerate((info, info.limit(3))):
        write_topic(part, cfg, S.TOPIC_DWD_ORDER_INFO, i)
        write_topic(detail if i == 0 else detail.limit(0), cfg, S.TOPIC_DWD_ORDER_DETAIL, i)
        ran += jobs.order_wide_job(spark, cfg, Q._dims(spark, SF001), C.AS_OF, C.ORDER_BAND_MS,
                                   C.ORDER_BAND_MS, trigger=ONCE, state_root=os.path.join(base, "state"))
        _finish(ran)
    assert not any(p["stateOperators"] for q in ran for p in q.recentProgress)
    counts = read_topic(spark, cfg, "order_wide_metrics", streaming=False).select(
        F.get_json_object("value", "$.rows_dropped").cast("int").alias("n"))
    assert sum(r.n for r in counts.collect()) == 3
    assert read_topic(spark, cfg, S.TOPIC_DWM_ORDER_WIDE, streaming=False).count() == \
        Q.order_wide(spark, SF001).count()


def test_log_detail_job_persists_no_frame(spark, env, monkeypatch):
    """The records of a batch do not pass through the executors' storage memory."""
    base, cfg = env
    rows = [f'{{"common":{{"mid":"m{i % 3}"}},"page":{{"page_id":"p"}},"ts":{i}}}' for i in range(30)]
    write_topic(spark.createDataFrame([(r,) for r in [*rows, "{broken"]], "value string"), cfg,
                S.TOPIC_ODS_LOG, 0)
    plans, write = [], jobs.write_batch

    def watched(records, *args):
        plans.append(records._jdf.queryExecution().toString())
        write(records, *args)

    monkeypatch.setattr(jobs, "write_batch", watched)
    _finish(jobs.log_detail_job(spark, cfg, HOUR, trigger=ONCE, state_root=os.path.join(base, "state")))
    assert plans and not any("InMemoryTableScan" in p for p in plans)
    assert not os.path.exists(os.path.join(base, "state", "log_detail", "state", "work"))
    assert read_topic(spark, cfg, S.TOPIC_ODS_LOG + "_quarantine", streaming=False).collect()[0].value == "{broken"
