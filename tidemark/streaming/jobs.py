"""Streaming jobs: the reference's applications as Structured Streaming
queries from topic to topic.

W8: ``run_job`` is the job template: sources -> ``transform`` (X1, the job's
hook) -> one ``foreachBatch`` per output writing every branch of it.  Each
query keeps its progress under ``spark.checkpoint.dir`` (shared storage on a
cluster), so a restarted or re-scheduled job resumes where it stopped.
The visitor and wide-order jobs take their topics batch by batch through DataFrame
operators (``steps``), with what is undecided in tables (``state``).
W7: all file outputs of a micro-batch are committed by one manifest
(``sinks.topics``), so the next layer reads every record once.  Kafka output is
at least once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas as S
from tidemark.functions import scalar as fn
from tidemark.operators import cdc, dims, logs, orders
from tidemark.plans import config as C
from tidemark.operators.joins import checked_broadcast
from tidemark.session import configured_path, let_workers_import, require_state_provider
from tidemark.sinks import fs
from tidemark.sinks.dimensions import DimensionStore
from tidemark.sinks.topics import KEPT_COMMITS, addressed, to_topic, write_batch
from tidemark.sources.topics import TopicConfig, read_topic, read_topics
from tidemark.streaming import pipelines as SP
from tidemark.streaming import steps
from tidemark.streaming.state import BatchState

BatchWriter = Callable[[DataFrame, int], None]


def checkpoint_for(spark: SparkSession, job: str, output: str) -> str:
    return configured_path(spark, "jobs", job, output)


def run_job(spark: SparkSession, name: str, sources: dict[str, DataFrame],
            transform: Callable[[dict[str, DataFrame]], DataFrame | dict[str, DataFrame]],
            writers: dict[str, BatchWriter], trigger: dict | None = None,
            state_root: str | None = None) -> list[StreamingQuery]:
    """Start one query per output of ``transform(sources)``; output ``k`` is
    written by ``writers[k](batch_df, batch_id)``.  Progress is kept in
    ``state_root`` (default: ``jobs/`` under ``spark.checkpoint.dir``; one of the
    two must be set)."""
    require_state_provider(spark)
    let_workers_import(spark)
    outs = transform(sources)
    if isinstance(outs, DataFrame):
        outs = {"out": outs}
    trig = trigger or {"processingTime": f"{C.WINDOW_MS} milliseconds"}
    started = []
    for out_name, df in outs.items():
        writer = writers[out_name]
        q = (df.writeStream
             .foreachBatch(lambda b, i, w=writer: w(b, i))
             .option("checkpointLocation",
                     f"{state_root.rstrip('/')}/{name}/{out_name}" if state_root
                     else checkpoint_for(spark, name, out_name))
             .queryName(f"{name}__{out_name}")
             .trigger(**trig)
             .start())
        started.append(q)
    return started


# W6 ----------------------------------------------------------------------------------
def rows_dropped_by_watermark(query: StreamingQuery, recent: bool = False) -> int:
    """Late rows dropped by the stateful operators in the last micro-batch
    (``recent``: in all micro-batches the query still reports)."""
    progress = list(query.recentProgress) if recent else [query.lastProgress or {}]
    return sum(int(op.get("numRowsDroppedByWatermark", 0))
               for p in progress for op in (p or {}).get("stateOperators", []))


# ---- the applications ----------------------------------------------------------------

def _stepwise(spark: SparkSession, name: str, cfg: TopicConfig, topic: str, trigger: dict | None,
              state_root: str | None, step: Callable, outputs: Callable) -> list[StreamingQuery]:
    """A job that reads a topic once and takes it batch by batch through ``step(state,
    before, log)``; ``outputs(step, unparsable)`` gives its ``(topic, value)`` records.
    Rows dropped as late are counted in the topic ``<name>_metrics`` (W6)."""
    root = f"{state_root.rstrip('/')}/{name}/state" if state_root else configured_path(
        spark, "jobs", name, "state")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession        # a copy for this query; its batches are plain ones
        session.conf.set("spark.sql.adaptive.enabled", "true")
        state = BatchState(session, root)
        before = state.before(batch_id)
        record = F.from_json("value", S.APP_LOG).alias("r")
        sound = logs.any_field(F.col("r"), S.APP_LOG.fieldNames()).alias("sound")
        try:
            parsed = state.stage("parsed", batch.select("value", record).select("value", "r", sound))
            log = parsed.where("sound").select("r.*", F.col("value").alias(logs.RECORD))
            done = step(state, before, log)
            try:
                counts = session.createDataFrame(
                    [(batch_id, done.late, done.watermark)],
                    "batch_id long, rows_dropped long, watermark long")
                records = [to_topic(counts, f"{name}_metrics"),
                           *outputs(done.out, parsed.where("not sound").select("value"))]
                write_batch(reduce(DataFrame.unionByName, records), cfg, name, batch_id)
                done.finish(state, before, batch_id)
            finally:
                done.release()
        finally:
            state.drop_staged()

    src = {topic: read_topic(spark, cfg, topic, name)}
    return run_job(spark, name, src, lambda s: s[topic], {"out": write}, trigger, state_root)


def log_detail_job(spark: SparkSession, cfg: TopicConfig, window_ms: int = C.WINDOW_MS,
                   allowance_ms: int = C.OUT_OF_ORDER_MS, trigger: dict | None = None,
                   state_root: str | None = None):
    """ods_log -> first-visit flag -> dwd_start / dwd_page / dwd_displays;
    malformed text -> ods_log_quarantine.  The topic is read and parsed once."""
    def outputs(log: DataFrame, bad: DataFrame) -> list[DataFrame]:
        split = logs.split_logs(log)
        shown = logs.display_records(log.where("start is null and displays is not null"))
        return [to_topic(split["start"], S.TOPIC_DWD_START), to_topic(split["page"], S.TOPIC_DWD_PAGE),
                to_topic(shown, S.TOPIC_DWD_DISPLAYS), to_topic(bad, S.TOPIC_ODS_LOG + "_quarantine")]

    return _stepwise(spark, "log_detail", cfg, S.TOPIC_ODS_LOG, trigger, state_root,
                     lambda state, before, log: steps.first_visits(state, before, log, window_ms,
                                                                   allowance_ms), outputs)


def unique_visitor_job(spark: SparkSession, cfg: TopicConfig, window_ms: int = C.WINDOW_MS,
                       allowance_ms: int = C.OUT_OF_ORDER_MS, trigger: dict | None = None,
                       state_root: str | None = None):
    """dwd_page -> first page record per visitor and day -> dwm_uv."""
    return _stepwise(spark, "unique_visitor", cfg, S.TOPIC_DWD_PAGE, trigger, state_root,
                     lambda state, before, log: steps.daily_firsts(state, before, log, window_ms,
                                                                   allowance_ms),
                     lambda out, _bad: [to_topic(out, S.TOPIC_DWM_UV)])


def bounce_job(spark: SparkSession, cfg: TopicConfig, within_ms: int = C.PATTERN_WITHIN_MS,
               next_rule: str = "entry", emit: str = "both",
               allowance_ms: int = C.OUT_OF_ORDER_MS, trigger: dict | None = None,
               state_root: str | None = None):
    """dwd_page -> bounced entry pages -> dwm_user_jump_detail."""
    return _stepwise(spark, f"bounce_{next_rule}_{emit}", cfg, S.TOPIC_DWD_PAGE, trigger, state_root,
                     lambda state, before, log: steps.bounces(state, before, log, within_ms,
                                                              next_rule, emit, allowance_ms),
                     lambda out, _bad: [to_topic(out, S.TOPIC_DWM_USER_JUMP_DETAIL)])


def pinned_rules(spark: SparkSession, rules_path: str, pins: str, batch_id: int) -> DataFrame:
    """The rules in force when a batch was first met: the changelog is read once per batch,
    and what it gave is kept under the batch's id, so that a replay routes as the first
    time did (S7, J10).  Rules are configuration; their size is checked."""
    pin = f"{pins}/batch={batch_id}"
    if not fs.exists(spark, f"{pin}/_SUCCESS"):
        in_force = cdc.rules_in_force(spark.read.parquet(rules_path))
        checked_broadcast(in_force)         # refuses what is no configuration any more
        in_force.coalesce(1).write.mode("overwrite").parquet(pin)
        old = f"{pins}/batch={batch_id - KEPT_COMMITS}"
        if fs.exists(spark, old):
            fs.remove(spark, old)
    return spark.read.parquet(pin)


def db_detail_job(spark: SparkSession, cfg: TopicConfig, rules_path: str, dims_path: str,
                  ops: tuple[str, ...] = ("insert",), trigger: dict | None = None,
                  state_root: str | None = None):
    """ods_db -> clean -> rules in force -> column projection -> kafka-type
    records to the topic named by their rule, hbase-type records upserted
    into the dimension store, per-branch counts (incl. ``dropped``) to the
    ``db_detail_metrics`` topic.  The rules changelog (parquet) is read for
    every micro-batch, so a rule change applies from the next batch on; a
    replayed batch keeps its rules.  Records of a rule that cannot be stored
    (its key is not among its columns, or another rule of the table names another
    key) go to ``ods_db_quarantine``; the others go on."""
    src = {S.TOPIC_ODS_DB: read_topic(spark, cfg, S.TOPIC_ODS_DB, "db_detail")}
    store = DimensionStore(spark, dims_path)
    pins = f"{state_root.rstrip('/')}/db_detail/rules" if state_root else configured_path(
        spark, "jobs", "db_detail", "rules")

    def write(batch: DataFrame, batch_id: int) -> None:
        rules = pinned_rules(spark, rules_path, pins, batch_id)
        tables, bad = dims.storable([
            (r.sink_table, r.sink_columns, r.sink_pk)
            for r in rules.filter(F.col("sink_type") == S.SINK_TYPE_HBASE).collect()])
        projected = cdc.with_branch(cdc.project_columns(cdc.attach_rules(batch, rules)))
        unfit = (F.col("branch") == S.SINK_TYPE_HBASE) & F.concat_ws(
            "\n", "sink_table", "sink_columns", F.coalesce("sink_pk", F.lit(dims.DEFAULT_PK))).isin(bad)
        projected = projected.withColumn("branch", F.when(unfit, F.lit("quarantine")).otherwise(
            F.col("branch"))).persist()
        try:
            kafka = projected.filter(F.col("branch") == S.SINK_TYPE_KAFKA)
            hb = projected.filter(F.col("branch") == S.SINK_TYPE_HBASE).drop("branch")
            store.upsert(dims.dimension_rows(hb, pos_col="xoffset"), batch_id, tables)
            # Records of unknown sink types are not written, only counted
            counts = (projected.groupBy("branch").count()
                      .select(F.lit(int(batch_id)).alias("batch_id"), "branch", "count"))
            held_back = projected.filter(F.col("branch") == "quarantine").drop("branch")
            write_batch(addressed(kafka.select("sink_table", "data"), "sink_table").unionByName(
                to_topic(counts, "db_detail_metrics")).unionByName(
                to_topic(held_back, S.TOPIC_ODS_DB + "_quarantine")), cfg, "db_detail", batch_id)
        finally:
            projected.unpersist()

    return run_job(spark, "db_detail", src, lambda s: cdc.clean_changes(s[S.TOPIC_ODS_DB], ops),
                   {"out": write}, trigger, state_root)


def order_wide_job(spark: SparkSession, cfg: TopicConfig,
                   dim_tables: dict[str, DataFrame] | Callable[[DataFrame], dict[str, DataFrame]],
                   as_of: str | Callable[[], str], lower_ms: int = C.JOIN_BAND_MS, upper_ms: int = C.JOIN_BAND_MS,
                   allowance_ms: int = C.OUT_OF_ORDER_MS, trigger: dict | None = None,
                   state_root: str | None = None):
    """dwd_order_info + dwd_order_detail -> band join -> dimension enrichment ->
    dwm_order_wide.  Both topics are read as one stream and joined batch by batch, with
    the records that may still match held in tables.  Rows dropped as late are counted
    in the topic ``order_wide_metrics`` (W6).

    Enrichment runs per micro-batch: ``dim_tables`` may be a callable that
    returns the dimension frames for a batch (e.g. ``dimension_reader``), called
    with every batch so upserted dimension rows are seen by later orders, as
    the reference's per-record look-ups did; ``as_of`` may be a callable too, so
    that ages of a long-running job follow the calendar."""
    topics = (S.TOPIC_DWD_ORDER_INFO, S.TOPIC_DWD_ORDER_DETAIL)
    src = read_topics(spark, cfg, *topics, group="order_wide")
    root = f"{state_root.rstrip('/')}/order_wide/state" if state_root else configured_path(
        spark, "jobs", "order_wide", "state")

    def transform(s):
        return reduce(DataFrame.unionByName,
                      [s[t].select(F.lit(t).alias("topic"), "value") for t in topics])

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession        # a copy for this query; its batches are plain ones
        session.conf.set("spark.sql.adaptive.enabled", "true")
        state = BatchState(session, root)
        before = state.before(batch_id)
        info, detail = SP.parse_order_streams(*[
            batch.where(F.col("topic") == t).select("value") for t in topics])
        done = steps.wide_orders(state, before, info, detail, lower_ms, upper_ms, allowance_ms)
        facts = done.out
        try:
            if callable(dim_tables):
                facts = facts.persist()     # its keys are read before it is enriched
                done.cached.append(facts)
            tables = dim_tables(facts) if callable(dim_tables) else dim_tables
            now = as_of() if callable(as_of) else as_of
            wide = orders.enrich(facts, orders.order_wide_specs(tables, now))
            wide = wide.withColumn("sku_name", F.coalesce(F.col("dim_sku_name"), F.col("sku_name")))
            counts = session.createDataFrame(
                [(batch_id, done.late, done.watermark)],
                "batch_id long, rows_dropped long, watermark long")
            write_batch(to_topic(wide.select(*S.ORDER_WIDE_COLUMNS), S.TOPIC_DWM_ORDER_WIDE).unionByName(
                to_topic(counts, "order_wide_metrics")), cfg, "order_wide", batch_id)
            done.finish(state, before, batch_id)
        finally:
            done.release()

    return run_job(spark, "order_wide", src, transform, {"out": write}, trigger, state_root)


# The dimensions that grow with the data, and the fact column that names their rows.
LOOKED_UP = {S.DIM_USER_INFO: "user_id", S.DIM_SKU_INFO: "sku_id"}


def dimension_reader(store: DimensionStore,
                     names: tuple[str, ...] = (S.DIM_USER_INFO, S.DIM_BASE_PROVINCE,
                                               S.DIM_SKU_INFO, S.DIM_SPU_INFO,
                                               S.DIM_BASE_TRADEMARK, S.DIM_BASE_CATEGORY3)):
    """A ``dim_tables`` callable over the current content of the store: of users and skus
    the rows that the batch names, from their buckets alone; the small tables whole."""
    def read(batch: DataFrame) -> dict[str, DataFrame]:
        out = {n: store.lookup(n, batch.select(LOOKED_UP[n])) if n in LOOKED_UP else store.read(n)
               for n in names}
        missing = [n for n, d in out.items() if d is None]
        if missing:
            raise ValueError(f"dimension tables missing: {missing}")
        return out
    return read


# S9 ----------------------------------------------------------------------------------
def raw_log_landing_job(spark: SparkSession, cfg: TopicConfig, incoming_path: str,
                        landing_path: str, trigger: dict | None = None,
                  state_root: str | None = None):
    """Raw log text as it arrives -> daily folders ``dt=yyyy-MM-dd`` (day of
    the record's ``ts``, else of arrival) and, unchanged, the ods_log topic."""
    src = {"raw": spark.readStream.format("text").load(incoming_path)}

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()                     # read once, written twice
        try:
            (batch.withColumn("dt", fn.landing_day("value"))
             .withColumn("batch", F.lit(int(batch_id)))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("dt", "batch").text(landing_path))
            write_batch(to_topic(batch.select("value"), S.TOPIC_ODS_LOG), cfg, "raw_log_landing",
                        batch_id)
        finally:
            batch.unpersist()

    return run_job(spark, "raw_log_landing", src, lambda s: s["raw"], {"out": write}, trigger, state_root)
