"""Registered queries of the streaming jobs and sinks: each puts records derived
from the given tables on file topics below the shared folder, runs a job over
them to the end, and returns what its output holds.

But for ``stream_late_rows`` all records of a topic arrive in one batch, so none is
late; a closing record far in the future moves the watermark past every window, and
is left out."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import logs
from tidemark.plans import config as C
from tidemark.plans.queries import Query, _dims
from tidemark.session import BASE_CONF, STATE_PROVIDER, shared_path
from tidemark.sinks.dimensions import DimensionStore
from tidemark.sinks.topics import write_topic
from tidemark.sources import projections as P
from tidemark.sources.tables import spread, table
from tidemark.sources.topics import TopicConfig, from_records, read_topic
from tidemark.streaming import jobs

ONCE = {"availableNow": True}
WINDOW_MS = 6 * 60 * 60 * 1000
CLOSING_TS = 4 * 10 ** 12
CLOSING = (f'{{"event_id":-1,"common":{{"mid":"closing"}},"page":{{"page_id":"closing"}},'
           f'"ts":{CLOSING_TS}}}')
NOT_CLOSING = "mid <> 'closing'"


def _place(spark: SparkSession) -> tuple[TopicConfig, str]:
    spark.conf.set(STATE_PROVIDER, BASE_CONF[STATE_PROVIDER])
    base = shared_path(spark, "stream", uuid.uuid4().hex)
    return TopicConfig(base_path=f"{base}/topics"), base


def _finish(queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def _closed(spark: SparkSession, text: DataFrame) -> DataFrame:
    return text.unionByName(from_records(spark, [CLOSING]))


def _read(spark: SparkSession, cfg: TopicConfig, topic: str) -> DataFrame:
    return logs.parse_app_log(read_topic(spark, cfg, topic, streaming=False)).withColumn(
        "mid", F.col("common.mid")).where(NOT_CLOSING)


def _path(p: str) -> Column:
    return F.get_json_object(logs.RECORD, p)


def _log_detail(spark: SparkSession, sf: str) -> TopicConfig:
    cfg, base = _place(spark)
    text = _closed(spark, P.open_log_text(table(spark, sf, "events")).unionByName(
        from_records(spark, ["{broken"])))
    write_topic(text, cfg, S.TOPIC_ODS_LOG, 0)
    _finish(jobs.log_detail_job(spark, cfg, WINDOW_MS, trigger=ONCE, state_root=f"{base}/state"))
    return cfg


def stream_log_detail(spark: SparkSession, sf: str) -> DataFrame:
    """ods_log -> log_detail job -> page topic: whole records and new-visitor flags."""
    pages = _read(spark, _log_detail(spark, sf), S.TOPIC_DWD_PAGE)
    return pages.groupBy(
        "mid", "ts", _path("$.common.uid").alias("uid"), _path("$.common.ar.code").alias("area"),
        _path("$.page.item").alias("page_item"), _path("$.err.no").alias("err_no")).agg(
        F.count("*").alias("n_records"),
        F.sum((F.col("common.is_new") == "1").cast("long")).alias("n_new"))


def stream_log_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """ods_log -> log_detail job: records per output topic, quarantine included."""
    cfg, out = _log_detail(spark, sf), None
    for name in (S.TOPIC_DWD_START, S.TOPIC_DWD_PAGE, S.TOPIC_DWD_DISPLAYS,
                 S.TOPIC_ODS_LOG + "_quarantine"):
        one = read_topic(spark, cfg, name, streaming=False).where(
            F.instr("value", '"closing"') == 0).select(F.lit(name).alias("topic"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("topic").agg(F.count("*").alias("n_records"))


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """ods_log -> log_detail job, started three times: the events up to a time, the
    later ones, and every tenth event again with a time long gone.  What the job's
    metrics topic says was dropped per batch, and the records of its page topic."""
    cfg, base = _place(spark)
    events = table(spark, sf, "events")
    cut = F.timestamp_millis(F.lit(C.LATE_CUT_MS))
    early = F.col("ts").cast("timestamp") < cut
    again = events.where("event_id % 10 = 0").withColumn(
        "ts", F.timestamp_millis(F.lit(1_000_000)).cast("timestamp_ntz"))
    for i, part in enumerate((events.where(early), events.where(~early), again)):
        write_topic(P.open_log_text(part), cfg, S.TOPIC_ODS_LOG, i)
        _finish(jobs.log_detail_job(spark, cfg, WINDOW_MS, trigger=ONCE, state_root=f"{base}/state"))
    counts = read_topic(spark, cfg, "log_detail_metrics", streaming=False).select(
        F.from_json("value", "batch_id long, rows_dropped long").alias("m")).select(
        F.lit("dropped").alias("what"), F.col("m.batch_id").alias("batch_id"),
        F.col("m.rows_dropped").alias("n_rows"))
    long_gone = F.col("ts") == 1_000_000
    pages = _read(spark, cfg, S.TOPIC_DWD_PAGE).agg(
        F.count_if(long_gone).alias("n")).select(
        F.lit("late pages written").alias("what"), F.lit(None).cast("long").alias("batch_id"),
        F.col("n").alias("n_rows"))
    return counts.unionByName(pages)


def _page_topic(spark: SparkSession, sf: str) -> tuple[TopicConfig, str]:
    cfg, base = _place(spark)
    pages = P.page_log(table(spark, sf, "events")).select(F.to_json(F.struct("*")).alias("value"))
    write_topic(_closed(spark, pages), cfg, S.TOPIC_DWD_PAGE, 0)
    return cfg, base


def stream_unique_visitor(spark: SparkSession, sf: str) -> DataFrame:
    """dwd_page -> unique_visitor job -> dwm_uv topic."""
    cfg, base = _page_topic(spark, sf)
    _finish(jobs.unique_visitor_job(spark, cfg, WINDOW_MS, trigger=ONCE,
                                    state_root=f"{base}/state"))
    from tidemark.functions import scalar as fn
    return _read(spark, cfg, S.TOPIC_DWM_UV).select(
        "mid", fn.ms_to_date_text("ts").alias("visit_date"), "ts", "event_id",
        F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"))


def _bounces(spark, sf, next_rule, emit) -> DataFrame:
    cfg, base = _page_topic(spark, sf)
    _finish(jobs.bounce_job(spark, cfg, C.BOUNCE_WITHIN_MS, next_rule, emit, trigger=ONCE,
                            state_root=f"{base}/state"))
    return _read(spark, cfg, S.TOPIC_DWM_USER_JUMP_DETAIL).select(
        "mid", "ts", "event_id", F.col("page.page_id").alias("page_id"))


def stream_bounce(spark: SparkSession, sf: str) -> DataFrame:
    """dwd_page -> bounce job -> jump-detail topic."""
    return _bounces(spark, sf, "entry", "both")


def stream_bounce_timeout(spark: SparkSession, sf: str) -> DataFrame:
    """dwd_page -> the timeout-only variant of the bounce job."""
    return _bounces(spark, sf, "non_entry", "timeout")


def _db_detail(spark: SparkSession, sf: str, changes: DataFrame) -> tuple[TopicConfig, str]:
    cfg, base = _place(spark)
    write_topic(changes.select(F.to_json(F.struct("*")).alias("value")), cfg, S.TOPIC_ODS_DB, 0)
    C.rule_history(spark).write.parquet(f"{base}/rules")
    _finish(jobs.db_detail_job(spark, cfg, f"{base}/rules", f"{base}/dims", trigger=ONCE,
                               state_root=f"{base}/state"))
    return cfg, base


def stream_db_topics(spark: SparkSession, sf: str) -> DataFrame:
    """ods_db -> db_detail job -> the topic each record's rule names."""
    cfg, _ = _db_detail(spark, sf, P.change_log(table(spark, sf, "customer"),
                                                table(spark, sf, "part")))
    data = read_topic(spark, cfg, "dwd_part", streaming=False).select(
        F.from_json("value", "map<string,string>").alias("d"))
    return data.select(F.lit("dwd_part").alias("sink_table"),
                       (F.col("d")["p_partkey"].cast("long") * 1000).alias("ts"),
                       F.explode("d").alias("col_name", "col_value"))


def stream_dimension_store(spark: SparkSession, sf: str) -> DataFrame:
    """ods_db -> db_detail job -> dimension store, read back: many versions per key."""
    _, base = _db_detail(spark, sf, P.order_driven_changes(table(spark, sf, "orders")))
    return DimensionStore(spark, f"{base}/dims").read("dim_user_info")


def stream_raw_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines -> landing job: what the daily folders and the ods_log topic hold."""
    cfg, base = _place(spark)
    P.app_log_text(table(spark, sf, "events")).write.text(f"{base}/incoming")
    _finish(jobs.raw_log_landing_job(spark, cfg, f"{base}/incoming", f"{base}/landing",
                                     trigger=ONCE, state_root=f"{base}/state"))
    landed = spark.read.text(f"{base}/landing").select("value", F.col("dt").cast("string"))
    sent = read_topic(spark, cfg, S.TOPIC_ODS_LOG, streaming=False).select(
        F.get_json_object("value", "$.event_id").alias("id"))
    return landed.select("dt", F.get_json_object("value", "$.event_id").alias("id")).join(
        sent, "id").groupBy("dt").agg(F.count("*").alias("n_records"))


def stream_order_wide(spark: SparkSession, sf: str) -> DataFrame:
    """dwd_order_info and dwd_order_detail -> order_wide job -> dwm_order_wide topic."""
    cfg, base = _place(spark)
    info = P.order_info(spread(table(spark, sf, "orders")))
    detail = P.order_detail(spread(table(spark, sf, "lineitem")))
    write_topic(info, cfg, S.TOPIC_DWD_ORDER_INFO, 0)
    write_topic(detail, cfg, S.TOPIC_DWD_ORDER_DETAIL, 0)
    _finish(jobs.order_wide_job(spark, cfg, _dims(spark, sf), lambda: C.AS_OF, C.ORDER_BAND_MS,
                                C.ORDER_BAND_MS, trigger=ONCE, state_root=f"{base}/state"))
    fields = ("detail_id long, order_id long, sku_id long, sku_num long, sku_name string, "
              "user_id long, user_age int, user_gender string, province_name string, "
              "spu_name string, tm_name string, category3_name string, create_date string")
    return read_topic(spark, cfg, S.TOPIC_DWM_ORDER_WIDE, streaming=False).select(
        F.from_json("value", fields).alias("r")).select("r.*")


STREAM_QUERIES: dict[str, Query] = {
    "stream_log_detail": stream_log_detail,
    "stream_log_outputs": stream_log_outputs,
    "stream_late_rows": stream_late_rows,
    "stream_unique_visitor": stream_unique_visitor,
    "stream_bounce": stream_bounce,
    "stream_bounce_timeout": stream_bounce_timeout,
    "stream_db_topics": stream_db_topics,
    "stream_dimension_store": stream_dimension_store,
    "stream_raw_landing": stream_raw_landing,
    "stream_order_wide": stream_order_wide,
}
