"""Structured Streaming forms of the warehouse operators.

Every function takes a *streaming* DataFrame and returns one; the same
record shapes and rules as the batch functions apply.  Durations are
parameters whose defaults are the reference's (3 s out-of-order allowance,
5 s windows, 5 s pattern band, +-5 s join band).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as fn
from tidemark.operators import logs, orders
from tidemark.plans import config as C
from tidemark.streaming.processors import (BOUNCE_OUT, FIRST_EVENT_OUT, NOBODY, BounceProcessor,
                                           DailyFirstProcessor, NewVisitorProcessor)

EVENT_TIME = "event_time"


def ms(n: int) -> str:
    return f"{int(n)} milliseconds"


# W0 -------------------------------------------------------------------------------
def with_event_time(df: DataFrame, ts_col: str = "ts",
                    allowance_ms: int = C.OUT_OF_ORDER_MS) -> DataFrame:
    """Event time from epoch-ms ``ts`` (TIMESTAMP: watermarks refuse NTZ) and a
    bounded out-of-order watermark."""
    return (df.withColumn(EVENT_TIME, fn.ms_to_timestamp(ts_col))
            .withWatermark(EVENT_TIME, ms(allowance_ms)))


# W1 + W2 / W3 ---------------------------------------------------------------------
def with_window_time(df: DataFrame, window_ms: int, ts_col: str = "ts",
                     allowance_ms: int = C.OUT_OF_ORDER_MS) -> DataFrame:
    """Event time is the end of the record's tumbling window, so a record is
    late only once its whole window is.  The watermark is held back by one window:
    it lies below the one of single records by less than a window, and nothing is
    dropped that would be kept there."""
    end = F.floor(F.col(ts_col) / F.lit(int(window_ms))) * int(window_ms) + int(window_ms)
    return (df.withColumn(EVENT_TIME, fn.ms_to_timestamp(end.cast("long")))
            .withWatermark(EVENT_TIME, ms(allowance_ms + window_ms)))


def _record(log: DataFrame) -> F.Column:
    """The text a record travels as: its raw text, else its columns as JSON."""
    return F.col(logs.RECORD) if logs.RECORD in log.columns else F.to_json(F.struct(*log.columns))


def _typed(log: DataFrame, value: str = "value") -> list[F.Column]:
    """The columns of ``log`` back from that text."""
    schema = log.drop(logs.RECORD).schema
    r = F.from_json(value, schema)
    return [F.col(value).alias(logs.RECORD) if c == logs.RECORD else r[c].alias(c)
            for c in log.columns]


def _keyed_records(log: DataFrame, window_ms: int, allowance_ms: int) -> DataFrame:
    day_start = F.date_trunc("day", fn.ms_to_timestamp("ts"))
    return (with_window_time(log, window_ms, "ts", allowance_ms)
            .select(F.col("common.mid").alias("mid"), "ts", logs.tie_of(log).alias("event_id"),
                    fn.ms_to_date_text("ts").alias("day"),
                    F.unix_millis(day_start + F.expr("INTERVAL 1 DAY")).alias("day_end"),
                    _record(log).alias("value"), EVENT_TIME))


def flag_new_visitors_stream(log: DataFrame, window_ms: int = C.WINDOW_MS,
                             allowance_ms: int = C.OUT_OF_ORDER_MS) -> DataFrame:
    """App-log records with ``common.is_new`` rewritten, ``1`` on the first
    record ever of a visitor.  All records are emitted (T1).  The first
    record is decided when its ``window_ms`` tumbling window closes (W1).
    Records without a visitor are never new and touch no state."""
    recs = _keyed_records(log, window_ms, allowance_ms)
    # Without a visitor: keys that are spread out and that the processor lets through.
    nobody = F.concat(F.lit(NOBODY), F.pmod("event_id", F.lit(1024)).cast("string"))
    flagged = (recs.withColumn("mid", F.coalesce("mid", nobody)).groupBy("mid")
               .transformWithState(NewVisitorProcessor(window_ms), FIRST_EVENT_OUT,
                                   "append", "EventTime"))
    return (flagged.select(*_typed(log), "is_new")
            .withColumn("common", fn.with_is_new("common", F.col("is_new")))
            .select(*log.columns))


def daily_unique_visitors_stream(page_log: DataFrame, window_ms: int = C.WINDOW_MS,
                                 allowance_ms: int = C.OUT_OF_ORDER_MS) -> DataFrame:
    """The first page record of each visitor per day, whole, as ``(mid,
    visit_date, the record's columns)``, emitted when its ``window_ms`` window
    closes."""
    recs = _keyed_records(page_log.where("common.mid is not null"), window_ms, allowance_ms)
    firsts = (recs.groupBy("mid")
              .transformWithState(DailyFirstProcessor(window_ms), FIRST_EVENT_OUT,
                                  "append", "EventTime"))
    return firsts.select("mid", fn.ms_to_date_text("ts").alias("visit_date"), *_typed(page_log))


# W4 / W5 / U1 ----------------------------------------------------------------------
def bounce_stream(page_log: DataFrame, within_ms: int = C.PATTERN_WITHIN_MS,
                  next_rule: str = "entry", emit: str = "both",
                  allowance_ms: int = C.OUT_OF_ORDER_MS,
                  start_when=None, next_when=None) -> DataFrame:
    """Bounce detail on a stream: the bounced entry records, whole (see
    ``logs.bounce_visits`` for the rule and the X3 step predicates).  Records
    later than the watermark are dropped, by record, as in the reference's
    pattern operator; so are records without a visitor."""
    start, follows = logs.pattern_predicates(next_rule, start_when, next_when)
    x = (with_event_time(page_log.where("common.mid is not null"), "ts", allowance_ms)
         .select(F.col("common.mid").alias("mid"), "ts",
                 logs.tie_of(page_log).alias("event_id"), start.alias("entry"),
                 follows.alias("ok"), F.when(start, _record(page_log)).alias("value"), EVENT_TIME))
    return (x.groupBy("mid")
            .transformWithState(BounceProcessor(within_ms, emit), BOUNCE_OUT, "append",
                                "EventTime").select(*_typed(page_log)))


# J1 ---------------------------------------------------------------------------------
def order_interval_join_stream(info: DataFrame, detail: DataFrame,
                               lower_ms: int = C.JOIN_BAND_MS, upper_ms: int = C.JOIN_BAND_MS,
                               allowance_ms: int = C.OUT_OF_ORDER_MS) -> DataFrame:
    """Stream-stream inner band join; state on both sides is evicted by the
    watermarks, bounded by the band plus the allowance."""
    i = (info.withColumn("i_time", fn.ms_to_timestamp("create_ts"))
         .withWatermark("i_time", ms(allowance_ms)).alias("i"))
    d = (detail.withColumn("d_time", fn.ms_to_timestamp("create_ts"))
         .withWatermark("d_time", ms(allowance_ms)).alias("d"))
    cond = ((F.col("i.id") == F.col("d.order_id"))
            & (F.col("d.d_time") >= F.col("i.i_time") - F.expr(f"INTERVAL {int(lower_ms)} MILLISECONDS"))
            & (F.col("d.d_time") <= F.col("i.i_time") + F.expr(f"INTERVAL {int(upper_ms)} MILLISECONDS")))
    return orders.merge_wide(i.join(d, cond, "inner"))


def parse_order_streams(info_text: DataFrame, detail_text: DataFrame):
    return orders.parse_order_info(info_text), orders.parse_order_detail(detail_text)
