"""The visitor jobs, one micro-batch at a time: the batch operators over what has
arrived, with the undecided rest kept in tables (``streaming.state``).

A step drops late rows (counted), moves the watermark by the batch, decides what the
new watermark allows and holds the rest.  Deciding by the watermark after the batch
is what a no-data batch right behind it would do.  No visitor's records pass through
Python, and none are gathered: the operators are those of ``operators.logs``, which
split a hot visitor.

* first visits (W2): records of visitors already decided pass at once; only the
  others' are held, until the window of their first record closes, and then released
  together, so that the jobs downstream see them in order.
* daily first records (W3): one record per visitor and open day is held; emitted
  (visitor, day) pairs are kept as keys that expire with their day.
* bounces (W4, W5): the records of the last band are held, nothing older.
* wide orders (J1): orders and details are held as long as one on time may still
  match them; each batch meets the other side's new and held records in one join.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as fn
from tidemark.operators import logs, orders
from tidemark.streaming.state import BatchState

DAY_MS = 24 * 60 * 60 * 1000


@dataclass
class Step:
    """What a micro-batch gives: the output rows, how many rows were late, and what
    ``finish`` writes as the state after it."""
    out: DataFrame
    late: int
    watermark: int | None
    held: dict[str, DataFrame]
    new_keys: DataFrame | None = None
    cached: list[DataFrame] = field(default_factory=list)
    values: dict = field(default_factory=dict)

    def finish(self, state: BatchState, before: dict, batch_id: int) -> None:
        values = dict(self.values)
        if self.watermark is not None:
            values["watermark"] = self.watermark
        state.write(batch_id, before, self.held, values, self.new_keys, self.watermark)

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()


def _window_end(ts: Column, window_ms: int) -> Column:
    return (F.floor(ts / F.lit(int(window_ms))) * int(window_ms) + int(window_ms)).cast("long")


def _on_time(rows: DataFrame, before: dict, time: Column, delay_ms: int):
    """``rows`` that are not late, the number of those that are, and the watermark
    after the batch.  A row without a time is never late."""
    old = before["values"].get("watermark")
    late = F.lit(False) if old is None else F.coalesce(time <= old, F.lit(False))
    top, n = rows.agg(F.max(time), F.count_if(late)).first()
    new = old if top is None else max(top - delay_ms, old if old is not None else top - delay_ms)
    return rows.where(~late), int(n), new


def first_visits(state: BatchState, before: dict, log: DataFrame, window_ms: int,
                 allowance_ms: int) -> Step:
    """W2 over one batch of ``log`` (see ``logs.flag_new_visitors``)."""
    rows, late, watermark = _on_time(log, before, _window_end(F.col("ts"), window_ms),
                                     allowance_ms + window_ms)
    keyed = rows.withColumn("_mid", F.when(F.col("ts").isNotNull(), F.col("common.mid")))
    seen = state.lookup(before, keyed.select(F.col("_mid").alias("key"))).select(
        F.col("key").alias("_mid"), F.lit(True).alias("_seen"))
    joined = keyed.join(seen, "_mid", "left") if before["seen"] else keyed.withColumn(
        "_seen", F.lit(None).cast("boolean"))
    passes = F.col("_seen").isNotNull() | F.col("_mid").isNull()
    known = joined.where(passes).select(*log.columns)
    undecided = joined.where(~passes).select(*log.columns).unionByName(
        state.held(before, "undecided", log.schema))
    marked = logs.mark_earliest(undecided, {"_mid": F.col("common.mid")})
    first = undecided.groupBy(F.col("common.mid").alias("_mid")).agg(F.min("ts").alias("_ts"))
    limit = F.lit(watermark).cast("long")
    decided = first.where(_window_end(F.col("_ts"), window_ms) <= limit).select("_mid")
    marked = state.stage("marked", marked.join(decided.withColumn("_done", F.lit(True)), "_mid", "left"))
    done = F.col("_done").isNotNull()
    flag = lambda df, new: df.withColumn(
        "common", fn.with_is_new("common", new)).select(*log.columns)
    out = flag(known, F.lit("0")).unionByName(flag(
        marked.where(done), F.when(F.col("_first"), F.lit("1")).otherwise(F.lit("0"))))
    new_keys = marked.where(done & F.col("_first")).select(
        F.col("_mid").alias("key"), F.lit(None).cast("long").alias("until"))
    return Step(out, late, watermark, {"undecided": marked.where(~done).select(*log.columns)},
                new_keys)


def daily_firsts(state: BatchState, before: dict, page_log: DataFrame, window_ms: int,
                 allowance_ms: int) -> Step:
    """W3 over one batch of page records (see ``logs.daily_unique_visitors``)."""
    rows, late, watermark = _on_time(page_log, before, _window_end(F.col("ts"), window_ms),
                                     allowance_ms + window_ms)
    day = fn.ms_to_date_text("ts")
    key = F.concat(day, F.lit("|"), F.col("common.mid"))
    keyed = rows.where("common.mid is not null and ts is not null").withColumn("key", key)
    if before["seen"]:
        keyed = keyed.join(state.lookup(before, keyed.select("key")), "key", "left_anti")
    open_days = keyed.select(*page_log.columns).unionByName(
        state.held(before, "open", page_log.schema))
    firsts = logs.mark_earliest(open_days, {"_mid": F.col("common.mid"), "_day": day}).where(
        "_first").persist()
    ready = F.coalesce(_window_end(F.col("ts"), window_ms) <= F.lit(watermark).cast("long"),
                       F.lit(False))
    # Later records of the day are late once its last window has closed.
    until = (F.floor(F.col("ts") / DAY_MS) * DAY_MS + DAY_MS + int(window_ms)).cast("long")
    return Step(firsts.where(ready).select(*page_log.columns), late, watermark,
                {"open": firsts.where(~ready).select(*page_log.columns)},
                firsts.where(ready).select(key.alias("key"), until.alias("until")), [firsts])


def bounces(state: BatchState, before: dict, page_log: DataFrame, within_ms: int,
            next_rule: str, emit: str, allowance_ms: int) -> Step:
    """W4 / W5 over one batch of page records (see ``logs.bounce_visits``)."""
    rows, late, watermark = _on_time(page_log, before, F.col("ts"), allowance_ms)
    band = rows.where("common.mid is not null and ts is not null").unionByName(
        state.held(before, "band", page_log.schema)).persist()
    over = F.coalesce(F.col("ts") + int(within_ms) <= F.lit(watermark).cast("long"), F.lit(False))
    # A start is decided once its band is over; what is decided is held no longer.
    return Step(logs.bounce_visits(band, within_ms, next_rule, emit).where(over), late, watermark,
                {"band": band.where(~over)}, None, [band])


HELD = "_held"


def wide_orders(state: BatchState, before: dict, info: DataFrame, detail: DataFrame, lower_ms: int,
                upper_ms: int, allowance_ms: int) -> Step:
    """J1 over one batch of orders and details (see ``orders.interval_join``).  The
    watermark follows the slower of the two topics, and there is none before both have
    brought a time.  Records without a key or a time match nothing."""
    old = before["values"].get("watermark")
    time = F.col("create_ts")
    late_at = F.lit(False) if old is None else F.coalesce(time <= old, F.lit(False))
    sides = {"info": (info, "id", upper_ms), "detail": (detail, "order_id", lower_ms)}
    tops, late, cached, rows = {}, 0, [], {}
    for name, (df, key, _) in sides.items():
        df = df.persist()
        cached.append(df)
        top, n = df.agg(F.max(time), F.count_if(late_at)).first()
        tops[name] = max((t for t in (top, before["values"].get(name)) if t is not None), default=None)
        late += n
        fresh = df.where(~late_at & F.col(key).isNotNull() & time.isNotNull())
        rows[name] = fresh.withColumn(HELD, F.lit(False)).unionByName(
            state.held(before, name, df.schema).withColumn(HELD, F.lit(True)))
    watermark = None if None in tops.values() else max(
        w for w in (min(tops.values()) - allowance_ms, old) if w is not None)
    limit = F.lit(watermark).cast("long")
    # What may still match: the other side's next records lie above the watermark.
    held = {name: rows[name].where(F.coalesce(time + int(band) > limit, F.lit(True))).drop(HELD)
            for name, (_, _, band) in sides.items()}
    i, d = rows["info"].alias("i"), rows["detail"].alias("d")
    met = orders.band_condition(i, d, lower_ms, upper_ms) & ~(i[HELD] & d[HELD])
    return Step(orders.merge_wide(i.join(d, met, "inner")), int(late), watermark, held, None, cached, {
        name: top for name, top in tops.items() if top is not None})
