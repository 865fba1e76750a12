"""Projections of the driver tables onto the warehouse's record shapes.

The reference reads app logs, change records and order records from topics.
Here those topics are derived from the parquet tables, row for row, so every
query's work grows with the tables.  The same expressions are written in the
DuckDB oracle (``tidemark.plans.oracle``); keep both in step.

* app log      <- events (one raw log record per event)
* page log     <- events (the ``dwd_page`` shape fed to visitor metrics)
* change log   <- customer + part (one change record per row)
* order_info   <- orders, order_detail <- lineitem
* dimensions   <- customer, nation, part
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.scalar import DATETIME_FMT
from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.ranking import dense_ranks


def epoch_ms(ts: Column | str) -> Column:
    """Epoch milliseconds of a (possibly zone-less) timestamp, session zone UTC."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(c.cast("timestamp"))


def _k_of_props() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def app_log(events: DataFrame) -> DataFrame:
    """Raw app log records (nested), one per event.

    signup events are start logs; every other event is a page log whose
    ``last_page_id`` is empty for views (entry pages) and ``home`` otherwise.
    Each record carries ``k % 4`` display elements.  ``common.is_new`` is the
    value the client claims (``1`` on signup); the detail layer rewrites it.
    """
    is_signup = F.col("event_type") == "signup"
    n_disp = F.pmod(_k_of_props(), F.lit(4))
    displays = F.transform(
        F.array_repeat(F.lit(0), n_disp),
        lambda _x, j: F.struct(
            (F.col("event_id") * 10 + j + 1).cast("string").alias("item"),
            (j + 1).cast("int").alias("pos")),
    )
    return events.select(
        F.col("event_id"),
        F.struct(
            F.col("user_id").cast("string").alias("mid"),
            F.when(is_signup, F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
        ).alias("common"),
        F.when(is_signup, F.struct(
            F.col("event_type").alias("entry"),
            F.col("value").alias("loading_time"))).alias("start"),
        F.when(~is_signup, F.struct(
            F.col("event_type").alias("page_id"),
            F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
             .otherwise(F.lit("home")).alias("last_page_id"),
            F.col("value").alias("during_time"))).alias("page"),
        displays.alias("displays"),
        epoch_ms("ts").alias("ts"),
    )


def app_log_text(events: DataFrame) -> DataFrame:
    """The raw ``ods_log`` topic: one JSON text per event, absent keys omitted."""
    return app_log(events).select(F.to_json(F.struct("*")).alias("value"))


def open_log_text(events: DataFrame) -> DataFrame:
    """Raw log text as clients send it: no record id, fields that no schema
    declares at every level, and each record whose event id is a multiple of 50
    twice."""
    e = app_log(events)
    displays = F.transform("displays", lambda d: F.struct(
        d["item"].alias("item"), d["pos"].alias("pos"), F.lit("promotion").alias("display_type"),
        (d["pos"] * 2).alias("order")))
    open_record = e.select("event_id", F.struct(
        F.struct(F.col("common.mid").alias("mid"), F.lit("9").alias("is_new"),
                 (F.col("event_id") * 3).alias("uid"),
                 F.struct(F.concat(F.lit("area_"), F.col("common.mid")).alias("code")).alias("ar"))
        .alias("common"),
        "start",
        F.when(F.col("page").isNotNull(), F.struct(
            "page.page_id", "page.last_page_id", F.col("event_id").cast("string").alias("item")))
        .alias("page"),
        displays.alias("displays"), F.struct((F.col("event_id") % 7).alias("no")).alias("err"),
        "ts").alias("r"))
    times = F.when(F.col("event_id") % 50 == 0, 2).otherwise(1)
    return open_record.select(F.to_json("r").alias("value"),
                              F.explode(F.array_repeat(F.lit(0), times))).select("value")


def odd_log_text(events: DataFrame) -> DataFrame:
    """Legal raw log text that parsing and writing again would change: repeated keys at
    every level, numbers beyond a double or with trailing zeros, keys in any order or
    with escapes, blanks, and an ``is_new`` that comes twice, not at all or as a number."""
    e = app_log(events)
    k = F.col("event_id") % 3
    text = lambda *parts: F.concat(*[
        F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    claim = (F.when(k == 0, F.lit('"is_new":"9","is_new" :"8",')).when(k == 1, F.lit(""))
             .otherwise(F.lit('"is\\u005fnew": 9,')))
    shown = F.transform("displays", lambda d: text(
        '{"item":"', d["item"], '","n":1.10, "item":"', d["item"], '!","ts":5,"q":[{"a":"]}"}]}'))
    part = F.when(F.col("start").isNotNull(), F.lit('"start" : {"entry":"e\\"{","v":1e400},')).otherwise(
        text('"page":{"page_id":"x","z":{},"page_id":"', F.col("page.page_id"), '"},'))
    return e.select(text(
        '{"k":1,"big":1e400,"event_id":', F.col("event_id"), ',"common":{"mid":"other","is_new":"7"}, ',
        part, '"displays":[', F.array_join(shown, " , "), '],"ts":', F.col("ts"), ',"common" : {"uid":1.50,',
        claim, '"mid":"', F.col("common.mid"), '","uid":', F.col("event_id"), '} ,"k":{"b":0.10,"b":[]}}',
    ).alias("value"))


def page_log(events: DataFrame) -> DataFrame:
    """``dwd_page`` shape over all events: mid = user, page = event type,
    entry page (no last page) for view and signup."""
    return events.select(
        F.col("event_id"),
        F.struct(
            F.col("user_id").cast("string").alias("mid"),
            F.lit(None).cast("string").alias("is_new"),
        ).alias("common"),
        F.struct(
            F.col("event_type").alias("page_id"),
            F.when(F.col("event_type").isin("view", "signup"), F.lit(None).cast("string"))
             .otherwise(F.lit("home")).alias("last_page_id"),
            F.col("value").alias("during_time"),
        ).alias("page"),
        epoch_ms("ts").alias("ts"),
    )


def _money_text(c: str) -> Column:
    return F.col(c).cast(S.MONEY).cast("string")


def _change_type(key: str) -> Column:
    m = F.pmod(F.col(key), F.lit(4))
    return (F.when(m == 0, F.lit("bootstrap-insert"))
             .when(m == 1, F.lit("update"))
             .otherwise(F.lit("insert")))


CHANGE_DATABASE = "shop"


def change_log(customer: DataFrame, part: DataFrame) -> DataFrame:
    """Change records of the customer and part tables, ``data`` as a string map.

    The record time is the snapshot order: key * 1000 ms.
    """
    cust = customer.select(
        F.lit(CHANGE_DATABASE).alias("database"),
        F.lit("customer").alias("table"),
        _change_type("c_custkey").alias("type"),
        (F.col("c_custkey") * 1000).alias("ts"),
        F.create_map(
            F.lit("c_custkey"), F.col("c_custkey").cast("string"),
            F.lit("c_name"), F.col("c_name"),
            F.lit("c_nationkey"), F.col("c_nationkey").cast("string"),
            F.lit("c_acctbal"), _money_text("c_acctbal"),
            F.lit("c_mktsegment"), F.col("c_mktsegment"),
        ).alias("data"),
    )
    prt = part.select(
        F.lit(CHANGE_DATABASE).alias("database"),
        F.lit("part").alias("table"),
        _change_type("p_partkey").alias("type"),
        (F.col("p_partkey") * 1000).alias("ts"),
        F.create_map(
            F.lit("p_partkey"), F.col("p_partkey").cast("string"),
            F.lit("p_name"), F.col("p_name"),
            F.lit("p_brand"), F.col("p_brand"),
            F.lit("p_type"), F.col("p_type"),
            F.lit("p_size"), F.col("p_size").cast("string"),
            F.lit("p_retailprice"), _money_text("p_retailprice"),
        ).alias("data"),
    )
    return cust.unionByName(prt)


def change_log_text(customer: DataFrame, part: DataFrame) -> DataFrame:
    """The raw ``ods_db`` topic: one JSON text per change record."""
    return change_log(customer, part).select(F.to_json(F.struct("*")).alias("value"))


def order_driven_changes(orders: DataFrame) -> DataFrame:
    """Several changes per customer, one per order, many at the same time: only
    the log position (``xoffset``) tells which is newer."""
    return orders.select(
        F.lit(CHANGE_DATABASE).alias("database"), F.lit("customer").alias("table"),
        F.lit("insert").alias("type"), (F.pmod("o_orderkey", F.lit(3)) * 1000).alias("ts"),
        F.col("o_orderkey").alias("xoffset"),
        F.create_map(
            F.lit("c_custkey"), F.col("o_custkey").cast("string"),
            F.lit("c_name"), F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")),
            F.lit("c_nationkey"), F.when(F.col("o_orderkey") % 5 != 0, F.lit("7")),
            F.lit("c_mktsegment"), F.col("o_orderstatus")).alias("data"))


def supplier_changes(supplier: DataFrame) -> DataFrame:
    """Changes of a table that no rule names."""
    return supplier.select(
        F.lit(CHANGE_DATABASE).alias("database"), F.lit("supplier").alias("table"),
        _change_type("s_suppkey").alias("type"), (F.col("s_suppkey") * 1000).alias("ts"),
        F.create_map(F.lit("s_suppkey"), F.col("s_suppkey").cast("string"),
                     F.lit("s_name"), F.col("s_name")).alias("data"))


def flawed_change_text(customer: DataFrame) -> DataFrame:
    """Change records with every flaw the cleaning looks for, by key: no data,
    no table, data too short, another type, no JSON; the others are sound."""
    k = F.pmod("c_custkey", F.lit(7))
    rec = customer.select(k.alias("k"), F.struct(
        F.lit(CHANGE_DATABASE).alias("database"),
        F.when(k != 1, F.lit("customer")).alias("table"),
        F.when(k == 3, F.lit("delete")).otherwise(F.lit("insert")).alias("type"),
        F.col("c_custkey").alias("ts"),
        F.when(k == 2, F.create_map(F.lit("a"), F.lit("b"))).when(
            k != 0, F.create_map(F.lit("c_custkey"), F.col("c_custkey").cast("string"),
                                 F.lit("c_name"), F.col("c_name"))).alias("data")).alias("r"))
    return rec.select(F.when(F.col("k") == 4, F.lit("no json")).otherwise(F.to_json("r"))
                      .alias("value"))


# ---- orders ----------------------------------------------------------------

def _null_money() -> Column:
    return F.lit(None).cast(S.MONEY)


def order_info(orders: DataFrame) -> DataFrame:
    """``dwd_order_info`` records (before the derived time columns)."""
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.pmod(F.col("o_custkey"), F.lit(25)).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(S.MONEY).alias("total_amount"),
        _null_money().alias("activity_reduce_amount"),
        _null_money().alias("coupon_reduce_amount"),
        _null_money().alias("original_total_amount"),
        _null_money().alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        F.date_format("o_orderdate", DATETIME_FMT).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    """``dwd_order_detail`` records.  ``id`` is a label only: the pair
    (l_orderkey, l_linenumber) repeats in the data, so nothing is keyed on it."""
    price = F.col("l_extendedprice").cast(S.MONEY)
    disc = F.col("l_discount").cast(S.MONEY)
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        price.alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        F.date_format("l_shipdate", DATETIME_FMT).alias("create_time"),
        (price * (F.lit(1) - disc)).cast(S.MONEY).alias("split_total_amount"),
        _null_money().alias("split_activity_amount"),
        _null_money().alias("split_coupon_amount"),
    )


# ---- dimension tables: every column text, key ID ----------------------------

def dim_user_info(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("string").alias("ID"),
        F.when(F.pmod(F.col("c_custkey"), F.lit(2)) == 0, F.lit("F"))
         .otherwise(F.lit("M")).alias("GENDER"),
        F.date_format(
            F.date_add(F.lit("1960-01-01").cast("date"),
                       F.pmod(F.col("c_custkey") * 37, F.lit(15000)).cast("int")),
            "yyyy-MM-dd").alias("BIRTHDAY"),
    )


def dim_base_province(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("string").alias("ID"),
        F.col("n_name").alias("NAME"),
        F.col("n_regionkey").cast("string").alias("AREA_CODE"),
        F.concat(F.lit("NK"), F.col("n_nationkey").cast("string")).alias("ISO_CODE"),
        F.concat(F.lit("NK-"), F.col("n_nationkey").cast("string")).alias("ISO_3166_2"),
    )


def _brand_number() -> Column:
    return F.regexp_extract("p_brand", r"([0-9]+)", 1)


def category3_ids(part: DataFrame) -> DataFrame:
    """``(p_type, CATEGORY3_ID)``: a category number per product type, its dense rank."""
    ranks = dense_ranks(part, "p_type", "CATEGORY3_ID")
    return ranks.withColumn("CATEGORY3_ID", F.col("CATEGORY3_ID").cast("string"))


def dim_sku_info(part: DataFrame, categories: DataFrame) -> DataFrame:
    """``categories`` from ``category3_ids``."""
    return part.join(broadcast_if_small(categories), "p_type", "left").select(
        F.col("p_partkey").cast("string").alias("ID"),
        F.col("p_name").alias("SKU_NAME"),
        F.pmod(F.col("p_partkey"), F.lit(100)).cast("string").alias("SPU_ID"),
        _brand_number().alias("TM_ID"),
        "CATEGORY3_ID")


def dim_spu_info(part: DataFrame) -> DataFrame:
    ids = part.select(F.pmod(F.col("p_partkey"), F.lit(100)).alias("k")).distinct()
    return ids.select(F.col("k").cast("string").alias("ID"),
                      F.concat(F.lit("spu_"), F.col("k").cast("string")).alias("SPU_NAME"))


def dim_base_trademark(part: DataFrame) -> DataFrame:
    return (part.select(_brand_number().alias("ID"), F.col("p_brand").alias("TM_NAME"))
            .distinct())


def dim_base_category3(categories: DataFrame) -> DataFrame:
    return categories.select(F.col("CATEGORY3_ID").alias("ID"), F.col("p_type").alias("NAME"))
