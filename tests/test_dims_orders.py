"""Dimension upsert, band join, snowflake enrichment, scalar functions."""

from __future__ import annotations

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import scalar as fn
from tidemark.operators import dims, orders


def test_dimension_rows_and_upsert(spark):
    routed = spark.createDataFrame(
        [({"id": "1", "name": "a"}, "dim_x", "id,name,city", None, 1),
         ({"id": "1", "name": "b", "city": "c"}, "dim_x", "id,name,city", None, 2),
         ({"id": "2", "name": None}, "dim_x", "id,name", "id", 1)],
        "data map<string,string>, sink_table string, sink_columns string, sink_pk string, ts long")
    rows = dims.dimension_rows(routed)
    snap = {(r.sink_table, r.pk): (r.seq, dict(r.data)) for r in dims.upsert(None, rows).collect()}
    assert snap == {("dim_x", "1"): (2, {"ID": "1", "NAME": "b", "CITY": "c"}),
                    ("dim_x", "2"): (1, {"ID": "2", "NAME": ""})}
    newer = spark.createDataFrame([("dim_x", "2", 5, 0, {"ID": "2", "NAME": "z"})],
                                  "sink_table string, pk string, seq long, pos long, "
                                  "data map<string,string>")
    snap2 = {r.pk: dict(r.data)["NAME"] for r in dims.upsert(dims.upsert(None, rows), newer).collect()}
    assert snap2 == {"1": "b", "2": "z"}


def test_table_schema_from_rule():
    sch = dims.table_schema("name,id,tm", "id")
    assert [f.name for f in sch.fields] == ["ID", "NAME", "TM"]
    assert all(f.dataType.simpleString() == "string" for f in sch.fields)


def _info(spark, rows):
    return orders.with_time_fields(spark.createDataFrame(
        [(i, 3, "1001", u, Decimal("10.00"), None, None, None, None, None, t, None)
         for i, u, t in rows], S.ORDER_INFO))


def _detail(spark, rows):
    return orders.with_time_fields(spark.createDataFrame(
        [(d, o, sku, Decimal("1.50"), 2, "own name", t, Decimal("3.00"), None, None)
         for d, o, sku, t in rows], S.ORDER_DETAIL), derive_date_hour=False)


def test_band_join_edges(spark):
    info = _info(spark, [(1, 7, "2021-08-02 10:00:10")])
    detail = _detail(spark, [
        (1, 1, 100, "2021-08-02 10:00:05"),   # -5 s: kept
        (2, 1, 100, "2021-08-02 10:00:15"),   # +5 s: kept
        (3, 1, 100, "2021-08-02 10:00:04"),   # -6 s: out
        (4, 1, 100, "2021-08-02 10:00:16"),   # +6 s: out
        (5, 9, 100, "2021-08-02 10:00:10"),   # no order
    ])
    got = sorted(r.detail_id for r in orders.interval_join(info, detail).collect())
    assert got == [1, 2]
    w = orders.interval_join(info, detail).collect()[0]
    assert (w.create_date, w.create_hour, w.expire_time, w.split_feight_fee) == \
        ("2021-08-02", "10", None, None)


def test_band_join_millisecond_edge(spark):
    info = orders.with_time_fields(_info(spark, [(1, 7, "2021-08-02 10:00:10")]))
    det = _detail(spark, [(1, 1, 100, "2021-08-02 10:00:15")]).withColumn(
        "create_ts", F.col("create_ts") + 1)   # +5.001 s
    assert orders.interval_join(info, det).count() == 0


def _dims(spark):
    t = "ID string, {}"
    return {
        S.DIM_USER_INFO: spark.createDataFrame([("7", "F", "2000-01-01")],
                                               t.format("GENDER string, BIRTHDAY string")),
        S.DIM_BASE_PROVINCE: spark.createDataFrame(
            [("3", "P3", "A", "I", "I2")],
            t.format("NAME string, AREA_CODE string, ISO_CODE string, ISO_3166_2 string")),
        S.DIM_SKU_INFO: spark.createDataFrame(
            [("100", "dim name", "5", "6", "8")],
            t.format("SKU_NAME string, SPU_ID string, TM_ID string, CATEGORY3_ID string")),
        S.DIM_SPU_INFO: spark.createDataFrame([("5", "spu5")], t.format("SPU_NAME string")),
        S.DIM_BASE_TRADEMARK: spark.createDataFrame([("6", "tm6")], t.format("TM_NAME string")),
        S.DIM_BASE_CATEGORY3: spark.createDataFrame([("8", "c8")], t.format("NAME string")),
    }


def test_order_wide_enrichment_and_misses(spark):
    info = _info(spark, [(1, 7, "2021-08-02 10:00:10"), (2, 99, "2021-08-02 10:00:10")])
    detail = _detail(spark, [(1, 1, 100, "2021-08-02 10:00:10"),
                             (2, 2, 555, "2021-08-02 10:00:10")])
    wide = orders.order_wide(info, detail, _dims(spark), as_of="2021-08-02 00:00:00")
    assert wide.columns == S.ORDER_WIDE_COLUMNS
    rows = {r.detail_id: r for r in wide.collect()}
    r = rows[1]
    assert (r.user_gender, r.user_age, r.province_name, r.sku_name, r.spu_id, r.tm_id,
            r.category3_id, r.spu_name, r.tm_name, r.category3_name) == \
        ("F", 21, "P3", "dim name", 5, 6, 8, "spu5", "tm6", "c8")
    m = rows[2]                          # unknown user and sku: nulls, detail name kept
    assert (m.user_gender, m.user_age, m.sku_name, m.spu_name) == (None, None, "own name", None)


def test_age_truncates_365_day_years(spark):
    df = spark.createDataFrame([("2000-01-01",), ("1999-01-02",)], "b string")
    got = [r.a for r in df.select(fn.age_years("b", "2001-01-01 00:00:00").alias("a")).collect()]
    # 2000 is a leap year: 366 days -> 1; 1999-01-02 -> 730 days -> 2
    assert got == [1, 2]




@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**13, 10**13), st.integers(-2**63, 2**63 - 1)),
                min_size=2, max_size=20))
def test_order_key_sorts_like_tuple(spark, pairs):
    df = spark.createDataFrame(pairs, "ts long, id long")
    got = [(r.ts, r.id) for r in df.orderBy(fn.order_key("ts", "id")).collect()]
    assert got == sorted(pairs)


def test_merge_maps_right_wins(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "9", "c": "3"})],
                               "l map<string,string>, r map<string,string>")
    got = dict(df.select(fn.merge_maps_right_wins("l", "r").alias("m")).collect()[0].m)
    assert got == {"a": "1", "b": "9", "c": "3"}


def test_order_wide_enrich_first_same_rows(spark):
    from tests.conftest import SF01
    from tidemark.plans import config as C
    from tidemark.plans import queries as Q
    info, detail = Q._orders(spark, SF01)
    dims = Q._dims(spark, SF01)
    a = orders.order_wide(info, detail, dims, C.AS_OF, C.ORDER_BAND_MS, C.ORDER_BAND_MS)
    b = orders.order_wide(info, detail, dims, C.AS_OF, C.ORDER_BAND_MS, C.ORDER_BAND_MS,
                          enrich_first=True)
    assert b.columns == a.columns
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_equal_times_are_decided_by_position(spark):
    rows = spark.createDataFrame(
        [("d", "1", 5, p, {"ID": "1", "NAME": n}) for p, n in ((3, "c"), (9, "z"), (1, "a"))],
        "sink_table string, pk string, seq long, pos long, data map<string,string>")
    assert [r.data["NAME"] for r in dims.upsert(None, rows).collect()] == ["z"]


def test_rules_without_their_key_are_refused(spark):
    import pytest
    with pytest.raises(ValueError, match="key column"):
        dims.table_schema("name,tm", "id")
    with pytest.raises(ValueError, match="different keys"):
        dims.union_rules([("d", "id,a", "id"), ("d", "id,a", "a")])
    assert dims.union_rules([("d", "id,a", None), ("d", "id,b", "id")]) == {"d": ("id,a,b", "id")}
    routed = spark.createDataFrame([({"name": "x"}, "d", "name", None, 1)],
                                   "data map<string,string>, sink_table string, "
                                   "sink_columns string, sink_pk string, ts long")
    with pytest.raises(Exception, match="rule without its key column"):
        dims.dimension_rows(routed).collect()


def test_age_of_blank_and_bad_birthdays(spark):
    df = spark.createDataFrame([("",), (None,), ("1990-02-31x",), ("1990-01-01",)], "b string")
    ages = [r.a for r in df.select(fn.age_years("b", "2024-01-01 00:00:00").alias("a")).collect()]
    assert ages == [None, None, None, 34]


def test_broadcast_refuses_what_is_no_configuration(spark):
    import pytest
    from tidemark.operators.joins import SideTooLarge, checked_broadcast
    with pytest.raises(SideTooLarge):
        checked_broadcast(spark.range(11), max_rows=10)
    with pytest.raises(SideTooLarge):
        checked_broadcast(spark.range(5), max_bytes=10)
    assert checked_broadcast(spark.range(5)).count() == 5
