"""The batch-wise jobs equal the batch operators, however the input is cut."""

from __future__ import annotations

import os
import random

import pytest
from tidemark.operators import logs
from tidemark.streaming import steps
from tidemark.streaming.state import KEY_SCHEMA, BatchState

SCHEMA = ("event_id long, common struct<mid string, is_new string>, "
          "page struct<page_id string, last_page_id string, during_time double>, ts long, record string")
DAY = 24 * 3_600_000


def visits(n: int, seed: int, span: int, hot: float = 0.34):
    """Records in time order, a third of them by one visitor, times repeat."""
    r = random.Random(seed)
    rows = []
    for i, ts in enumerate(sorted(r.randrange(span) for _ in range(n))):
        mid = "hot" if r.random() < hot else r.choice([None, *(f"v{j}" for j in range(40))])
        last = r.choice([None, "", "home"])
        rows.append((i, (mid, None), ("p", last, 1.0), ts, f"record {i}"))
    return rows


def batches(rows, cuts):
    edges = [0, *sorted(cuts), len(rows)]
    return [rows[a:b] for a, b in zip(edges, edges[1:])]


def drive(spark, root, parts, step, replay=False):
    """All batches through ``step``; the rows out, the late ones and the states."""
    state = BatchState(spark, root, max_buckets=8, bucket_rows=5)
    out, late, sizes = [], 0, []
    for i, part in enumerate(parts):
        for again in range(2 if replay else 1):
            before = state.before(i)
            done = step(state, before, spark.createDataFrame(part, SCHEMA))
            rows = [tuple(r) for r in done.out.collect()]
            done.finish(state, before, i)
            done.release()
            if again:
                assert sorted(rows, key=str) == sorted(got, key=str)
            got = rows
        after = state.before(i + 1)
        sizes.append({k: state.held(after, k, spark.createDataFrame([], SCHEMA).schema).collect()
                      for k in after["held"]})
        out += got
        late += done.late
    return out, late, sizes, after


END = [(10 ** 6, ("closing", None), ("p", None, 1.0), 400 * DAY, "end")]


@pytest.mark.parametrize("cuts", [[50, 180, 190, 260]])
def test_first_visits(spark, scratch, cuts):
    rows = visits(300, 1, 3 * DAY)
    got, late, _, after = drive(spark, scratch, [*batches(rows, cuts), END], lambda *a: steps.first_visits(
        *a, 3_600_000, 60_000), replay=len(cuts) == 4)
    want = logs.flag_new_visitors(spark.createDataFrame(rows, SCHEMA)).collect()
    flags = sorted((r[0], r[1].is_new) for r in got if r[0] < 10 ** 6)
    assert flags == sorted((r.event_id, r.common.is_new) for r in want) and late == 0
    assert len(after["seen"]) < 6
    # A visitor's records come out in order of time, batch by batch.
    place = {}
    for n, r in enumerate(got):
        place.setdefault(r[1].mid, []).append(r[0])
    assert len(place) == 42


def test_first_visits_are_staged_in_files(spark, scratch):
    """A batch larger than the executors' memory: no persisted frame holds its records."""
    rows = visits(200, 6, 2 * DAY)
    rows += [(None, *r[1:]) for r in rows[:20]] * 2         # records without an id that come twice
    plans, state = [], BatchState(spark, scratch)
    # A batch that was broken off has left a table of its own.
    state.stage("marked", spark.range(3)).count()

    def step(*args):
        done = steps.first_visits(*args, 3_600_000, 60_000)
        plans.extend(df._jdf.queryExecution().toString()
                     for df in (done.out, done.new_keys, *done.held.values()))
        assert not done.cached
        return done

    got, _, _, _ = drive(spark, scratch, [rows, END], step, replay=True)
    assert plans and not any("InMemoryTableScan" in p for p in plans)
    want = logs.flag_new_visitors(spark.createDataFrame(rows, SCHEMA)).collect()
    flags = sorted((str(r[0]), r[4], r[1].is_new) for r in got if r[0] != 10 ** 6)
    assert flags == sorted((str(r.event_id), r.record, r.common.is_new) for r in want)
    state.drop_staged()
    assert not any(n == "work" for n in os.listdir(scratch))


def test_late_records_of_closed_windows_are_dropped_and_counted(spark, scratch):
    def rec(i, mid, ts):
        return (i, (mid, None), ("p", None, 1.0), ts, "x")
    parts = [[rec(1, "a", 1000), rec(2, "a", 100_000)], [rec(3, "a", 500), rec(4, "b", 95_500)],
             [rec(5, "b", 200_000), rec(6, None, 7)], END]
    got, late, _, _ = drive(spark, scratch, parts, lambda *a: steps.first_visits(*a, 5_000, 3_000))
    assert sorted((r[0], r[1].is_new) for r in got if r[0] < 10) == [
        (1, "1"), (2, "0"), (4, "1"), (5, "0")] and late == 2


@pytest.mark.parametrize("cuts", [[50, 180, 190, 260]])
def test_daily_firsts(spark, scratch, cuts):
    rows = visits(300, 2, 4 * DAY)
    got, late, _, after = drive(spark, scratch, [*batches(rows, cuts), END], lambda *a: steps.daily_firsts(
        *a, 3_600_000, 60_000), replay=bool(cuts))
    want = logs.daily_unique_visitors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r[0] for r in got if r[0] < 10 ** 6) == sorted(r.event_id for r in want)
    assert late == 0
    # All days but the last are over: their keys are gone.
    assert sum(s["rows"] for s in after["seen"]) <= 1


@pytest.mark.parametrize("cuts", [[50, 180, 190, 260]])
@pytest.mark.parametrize("rule", [("entry", "both"), ("non_entry", "timeout")])
def test_bounces_hold_one_band(spark, scratch, cuts, rule):
    within, allowance = 1_800_000, 60_000
    rows = visits(300, 3, 2 * DAY)
    got, late, sizes, _ = drive(spark, scratch, [*batches(rows, cuts), END], lambda *a: steps.bounces(
        *a, within, *rule, allowance), replay=len(cuts) == 4)
    want = logs.bounce_visits(spark.createDataFrame(rows, SCHEMA).where("common.mid is not null"),
                              within, *rule).collect()
    assert sorted(r[0] for r in got if r[0] < 10 ** 6) == sorted(r.event_id for r in want)
    assert late == 0
    for held in sizes[:-1]:
        times = [r.ts for r in held["band"]]
        assert max(times) - min(times) <= within + allowance


def test_key_sets_read_only_touched_buckets_and_fold(spark, scratch):
    state = BatchState(spark, scratch, max_buckets=16, bucket_rows=4)
    keys = [f"k{i}" for i in range(200)]
    for b in range(10):
        new = spark.createDataFrame([(k, None if b % 2 else 100 + b) for k in keys[b * 20:b * 20 + 20]],
                                    KEY_SCHEMA)
        state.write(b, state.before(b), {}, {}, new, now=0)
    after = state.before(10)
    assert sum(s["rows"] for s in after["seen"]) == 200 and len(after["seen"]) <= 6
    asked = spark.createDataFrame([("k7",), ("nobody",)], "key string")
    found = state.lookup(after, asked)
    assert "k7" in {r.key for r in found.collect()}
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and found.count() < 120
    state.write(10, after, {}, {}, spark.createDataFrame([], KEY_SCHEMA), now=1000)
    left = state._read(state.before(11)["seen"]).where("until is null").count()
    assert left == 100


def orders_of(spark, infos, details):
    """Orders ``(id, ts)`` and details ``(id, order, ts)`` as the topics' parsed records."""
    from pyspark.sql import functions as F

    from tidemark import schemas as S

    def typed(rows, names, schema, more):
        df = spark.createDataFrame(rows, names + ", create_ts long")
        have = df.columns
        return df.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in schema], *more, "create_ts")
    info = typed(infos, "id long", S.ORDER_INFO, [
        F.lit(c).alias(c) for c in ("create_date", "create_hour")])
    return info, typed(details, "id long, order_id long", S.ORDER_DETAIL, [])


def test_wide_orders_hold_one_band(spark, scratch):
    lower, upper, allowance = 30, 50, 20
    r = random.Random(5)
    infos = [(r.randrange(40), t) for t in range(0, 1000, 12)] + [(None, 500), (3, None)]
    details = [(n, r.randrange(40), t) for n, t in enumerate(range(0, 1000, 3))] + [(-1, None, 5), (-2, 3, None)]
    state, got, late, sizes = BatchState(spark, scratch), [], 0, []
    # Details arrive a batch behind their orders; two records come long after their time.
    cut = lambda rows, a, b: [x for x in rows if a <= (500 if x[-1] is None else x[-1]) < b]
    parts = [(cut(infos, b * 100, b * 100 + 100), cut(details, b * 100 - 100, b * 100)) for b in range(11)]
    parts[9][0].append((7, 10))
    parts[9][1].append((-3, 7, 10))
    for i, part in enumerate(parts):
        for again in range(2 if i == 4 else 1):
            before = state.before(i)
            done = steps.wide_orders(state, before, *orders_of(spark, *part), lower, upper, allowance)
            rows = sorted((x.detail_id, x.order_id) for x in done.out.select("detail_id", "order_id").collect())
            done.finish(state, before, i)
            done.release()
            assert not again or rows == first
            first = rows
        got, late = got + rows, late + done.late
        after = state.before(i + 1)
        sizes.append([state.held(after, n, df.schema).agg({"create_ts": "min"}).first()[0]
                      for n, df in zip(("info", "detail"), orders_of(spark, [], []))])
    assert sorted(got) == sorted((d, o) for o, t in infos for d, p, u in details
                                 if None not in (o, p, t, u) and o == p and t - lower <= u <= t + upper)
    assert late == 2
    top = max(t for o, t in infos if t is not None)
    last = min(top, max(u for _, _, u in details if u is not None)) - allowance
    assert sizes[-1][0] is None or sizes[-1][0] > last - upper
    assert sizes[-1][1] > last - lower
