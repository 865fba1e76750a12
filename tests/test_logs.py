"""Log path: parse, first-visit flag, split, daily visitors, bounce."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import logs
from tidemark.sources.topics import from_records

PAGE_SCHEMA = "event_id long, common struct<mid:string,is_new:string>, " \
              "page struct<page_id:string,last_page_id:string>, ts long"


def _page_rows(rows):
    """rows: (mid, page_id, last_page_id, ts) -> page-log rows with ids."""
    return [(i, (mid, None), (pid, last), ts) for i, (mid, pid, last, ts) in enumerate(rows)]


# The two inline fixtures of the reference's bounce job and its hand test.
FIXTURE_A = [("101", "home", None, 10000), ("101", "home", None, 11000),
             ("102", "home", None, 10000), ("102", "good_list", "home", 17000),
             ("102", "good_list", "detail", 50000)]
FIXTURE_B = [("101", "home", None, 10000), ("101", "home", None, 11000),
             ("102", "home", None, 10000), ("102", "good_list", "home", 12000),
             ("102", "good_list", "detail", 50000)]


def _bounce(spark, rows, within=5000, next_rule="entry", emit="both"):
    df = spark.createDataFrame(_page_rows(rows), PAGE_SCHEMA)
    out = logs.bounce_visits(df, within, next_rule, emit)
    return sorted((r["common"]["mid"], r["ts"]) for r in out.collect())


def test_bounce_fixture_a(spark):
    assert _bounce(spark, FIXTURE_A) == [("101", 10000), ("101", 11000), ("102", 10000)]


def test_bounce_fixture_b(spark):
    assert _bounce(spark, FIXTURE_B) == [("101", 10000), ("101", 11000)]


def test_bounce_fixture_b_timeout_only(spark):
    assert _bounce(spark, FIXTURE_B, next_rule="non_entry", emit="timeout") == [("101", 11000)]


def test_bounce_gap_exactly_within_is_timeout(spark):
    rows = [("1", "home", None, 0), ("1", "list", "home", 5000)]
    assert _bounce(spark, rows) == [("1", 0)]
    rows = [("1", "home", None, 0), ("1", "list", "home", 4999)]
    assert _bounce(spark, rows) == []


def test_bounce_empty_last_page_is_entry(spark):
    rows = [("1", "home", "", 0), ("1", "home", "", 100000)]
    assert _bounce(spark, rows) == [("1", 0), ("1", 100000)]


def _naive_bounce(df, within, next_rule, emit):
    """Textbook form: lead over the whole visitor (the oracle's shape)."""
    w = Window.partitionBy("common.mid").orderBy("ts", "event_id")
    entry = F.coalesce(F.col("page.last_page_id"), F.lit("")) == ""
    non_entry = F.col("page.page_id").isNotNull() & (F.length("page.last_page_id") > 0)
    ok = F.coalesce(entry if next_rule == "entry" else non_entry, F.lit(False))
    x = (df.withColumn("_e", entry).withColumn("_ok", ok)
         .withColumn("_nts", F.lead("ts").over(w)).withColumn("_nok", F.lead("_ok").over(w)))
    timeout = F.col("_nts").isNull() | (F.col("_nts") - F.col("ts") >= within)
    keep = timeout if emit == "timeout" else (timeout | F.col("_nok"))
    return x.filter(F.col("_e") & keep).select("event_id")


page_row = st.tuples(st.sampled_from(["1", "2", "3"]),
                     st.sampled_from(["home", "list", "detail", None]),
                     st.sampled_from([None, "", "home"]),
                     st.integers(min_value=0, max_value=60_000))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(page_row, min_size=1, max_size=40),
       within=st.sampled_from([1000, 5000, 7000]),
       variant=st.sampled_from([("entry", "both"), ("non_entry", "timeout"),
                                ("non_entry", "both"), ("entry", "timeout")]))
def test_bounce_equals_whole_key_lead(spark, rows, within, variant):
    df = spark.createDataFrame(_page_rows(rows), PAGE_SCHEMA)
    got = sorted(r[0] for r in logs.bounce_visits(df, within, *variant).select("event_id").collect())
    want = sorted(r[0] for r in _naive_bounce(df, within, *variant).collect())
    assert got == want


def _log_text(spark, records):
    return from_records(spark, [r if isinstance(r, str) else json.dumps(r) for r in records])


RAW = [
    {"event_id": 1, "common": {"mid": "m1", "is_new": "1"}, "start": {"entry": "icon"}, "ts": 3000},
    {"event_id": 2, "common": {"mid": "m1", "is_new": "1"}, "page": {"page_id": "home"},
     "displays": [{"item": "a", "pos": 1}, {"item": "b", "pos": 2}], "ts": 1000},
    {"event_id": 3, "common": {"mid": "m2", "is_new": "0"}, "page": {"page_id": "home"},
     "displays": [], "ts": 5000},
    {"event_id": 4, "common": {"mid": "m2", "is_new": "0"},
     "displays": [{"item": "c", "pos": 1}], "ts": 4000},
    {"event_id": 5, "common": {"mid": "m3"}, "page": {"page_id": "x", "last_page_id": "home"},
     "ts": 7000},
    {"event_id": 6, "common": {"mid": "m3"}, "page": {"page_id": "y"}, "ts": 7000},
    "this is not json",
]


def test_parse_quarantines_malformed(spark):
    parsed = logs.parse_json(_log_text(spark, RAW), S.APP_LOG)
    good, bad = logs.split_corrupt(parsed)
    assert good.count() == 6
    assert [r.value for r in bad.collect()] == ["this is not json"]
    assert logs.parse_app_log(_log_text(spark, RAW)).count() == 6


def test_flag_new_visitors_first_record_only(spark):
    flagged = logs.flag_new_visitors(logs.parse_app_log(_log_text(spark, RAW)))
    got = {r.event_id: r.common.is_new for r in flagged.collect()}
    # m1: the page at ts 1000 precedes the start at 3000; m3: tie on ts -> smaller id
    assert got == {1: "0", 2: "1", 3: "0", 4: "1", 5: "1", 6: "0"}


def test_split_three_ways(spark):
    out = logs.split_logs(logs.parse_app_log(_log_text(spark, RAW)))
    assert sorted(r.event_id for r in out["start"].collect()) == [1]
    assert sorted(r.event_id for r in out["page"].collect()) == [2, 3, 5, 6]
    page2 = [r for r in out["page"].collect() if r.event_id == 2][0]
    assert len(page2.displays) == 2          # page record keeps its displays whole
    disp = sorted((r.item, r.pos, r.page_id, r.mid, r.ts) for r in out["displays"].collect())
    assert disp == [("a", 1, "home", "m1", 1000), ("b", 2, "home", "m1", 1000),
                    ("c", 1, None, "m2", 4000)]      # displays without page: page_id null


def test_display_field_clash_common_wins(spark):
    rec = {"event_id": 1, "common": {"mid": "m1", "is_new": "1"}, "page": {"page_id": "p"},
           "displays": [{"mid": "elem", "ts": 1, "page_id": "elem", "item": "i"}], "ts": 9}
    from pyspark.sql import types as T
    disp_t = T.StructType(list(S.DISPLAY.fields) + [
        T.StructField("mid", T.StringType()), T.StructField("ts", T.LongType()),
        T.StructField("page_id", T.StringType())])
    schema = T.StructType([f if f.name != "displays" else
                           T.StructField("displays", T.ArrayType(disp_t)) for f in S.APP_LOG.fields])
    df = logs.parse_json(_log_text(spark, [rec]), schema, keep_corrupt=False)
    r = logs.explode_displays(df).collect()[0]
    assert (r["mid"], r["page_id"], r["ts"], r["item"]) == ("m1", "p", 9, "i")


def test_daily_unique_visitors_per_record_day(spark):
    day = 86_400_000
    rows = [("1", "home", None, day - 1000), ("1", "home", None, day - 500),
            ("1", "home", None, day + 10), ("1", "home", None, day + 5),
            ("2", "home", None, 5), ("2", "list", "home", 5)]
    df = spark.createDataFrame(_page_rows(rows), PAGE_SCHEMA)
    got = sorted((r.mid, r.visit_date, r.ts, r.event_id)
                 for r in logs.daily_unique_visitors(df).collect())
    assert got == [("1", "1970-01-01", day - 1000, 0), ("1", "1970-01-02", day + 5, 3),
                   ("2", "1970-01-01", 5, 4)]


def test_bounce_with_sql_pattern_predicates(spark):
    """The steps as SQL text; here the default rule written out by hand."""
    df = spark.createDataFrame(_page_rows(FIXTURE_B), PAGE_SCHEMA)
    out = logs.bounce_visits(
        df, 5000, emit="timeout",
        start_when="coalesce(page.last_page_id, '') = ''",
        next_when="page.page_id IS NOT NULL AND length(page.last_page_id) > 0")
    assert sorted((r.common.mid, r.ts) for r in out.collect()) == [("101", 11000)]


def test_unparsable_lines(spark):
    got = sorted(r.value for r in logs.unparsable(_log_text(spark, RAW + ["{}"]), S.APP_LOG).collect())
    assert got == ["this is not json", "{}"]


OPEN = {"common": {"mid": "m1", "is_new": "1", "uid": 7, "ar": {"code": "x"}},
        "page": {"page_id": "home", "item": "i9"}, "err": {"no": 3}, "ts": 10,
        "displays": [{"item": "a", "pos": 1, "order": 2.5, "mid": "elem", "display_type": "p"}]}


def test_open_records_keep_undeclared_fields(spark):
    from tidemark.sinks.topics import as_value
    log = logs.flag_new_visitors(logs.parse_app_log(_log_text(spark, [OPEN])))
    back = json.loads(as_value(log).first().value)
    assert back == OPEN                                 # first ever: is_new stays 1
    two = logs.flag_new_visitors(logs.parse_app_log(_log_text(spark, [OPEN, {**OPEN, "ts": 99}])))
    later = [json.loads(r.value) for r in as_value(two).collect() if json.loads(r.value)["ts"] == 99]
    assert later == [{**OPEN, "ts": 99, "common": {**OPEN["common"], "is_new": "0"}}]
    shown = json.loads(logs.display_records(log).first().value)
    assert shown == {"item": "a", "pos": 1, "order": 2.5, "display_type": "p", "ts": 10,
                     "page_id": "home", **OPEN["common"]}
    odd = [{"ts": 1, "displays": [{"a": 1}, 5]}, {"common": None, "ts": 2}, {"page": "text", "ts": 3}]
    parsed = logs.flag_new_visitors(logs.parse_app_log(_log_text(spark, odd)))
    assert [json.loads(r.value) for r in as_value(parsed.orderBy("ts")).collect()] == odd


def test_first_visit_without_ids_or_with_shared_ids(spark):
    def flags(records):
        f = logs.flag_new_visitors(logs.parse_app_log(_log_text(spark, records)))
        return sorted((r.common.mid or "", r.ts, r.common.is_new) for r in f.collect())

    def rec(mid, ts, **more):
        return {"common": {"mid": mid, "is_new": "0"}, "page": {"page_id": "p"}, "ts": ts, **more}

    assert flags([rec("a", 5), rec("a", 9), rec("b", 5)]) == [
        ("a", 5, "1"), ("a", 9, "0"), ("b", 5, "1")]
    # A record that came twice: one of the two is the first.
    assert flags([rec("a", 5), rec("a", 5), rec("a", 9)]) == [
        ("a", 5, "0"), ("a", 5, "1"), ("a", 9, "0")]
    # Ids unique per visitor only.
    assert flags([rec("a", 5, event_id=1), rec("a", 9, event_id=2), rec("b", 3, event_id=2)]) == [
        ("a", 5, "1"), ("a", 9, "0"), ("b", 3, "1")]
    assert flags([rec(None, 5), rec(None, 6)]) == [("", 5, "0"), ("", 6, "0")]
