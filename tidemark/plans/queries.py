"""Registered queries: each reads the driver tables of one scale-factor folder,
runs one warehouse operator over all rows, and returns flat columns whose
names match the DuckDB SQL in ``tidemark.plans.oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import cdc, dims, logs, orders
from tidemark.plans import config as C
from tidemark.sinks.topics import as_value
from tidemark.sources import projections as P
from tidemark.sources.tables import spread, table

Query = Callable[[SparkSession, str], DataFrame]


# ---- log path ------------------------------------------------------------------
def _events(spark, sf):
    return spread(table(spark, sf, "events"))


def _page_log(spark, sf):
    return P.page_log(table(spark, sf, "events"))


def _flagged(text: DataFrame) -> DataFrame:
    return logs.flag_new_visitors(logs.parse_app_log(text), narrow=logs.parse_visits(text))


def _flagged_log(spark, sf):
    return _flagged(P.app_log_text(_events(spark, sf)))


def daily_unique_visitor(spark: SparkSession, sf: str) -> DataFrame:
    uv = logs.daily_unique_visitors(_page_log(spark, sf))
    return uv.select("mid", "visit_date", "ts", "event_id",
                     F.col("page.page_id").alias("page_id"),
                     F.col("page.last_page_id").alias("last_page_id"))


def new_visitor_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged_log(spark, sf).select(
        "event_id", F.col("common.mid").alias("mid"), "ts",
        F.col("common.is_new").alias("is_new"))


def split_start(spark: SparkSession, sf: str) -> DataFrame:
    return logs.split_logs(_flagged_log(spark, sf))["start"].select(
        "event_id", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
        "ts", F.col("start.entry").alias("entry"),
        F.col("start.loading_time").alias("loading_time"))


def split_page(spark: SparkSession, sf: str) -> DataFrame:
    return logs.split_logs(_flagged_log(spark, sf))["page"].select(
        "event_id", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
        "ts", F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.during_time").alias("during_time"),
        F.size("displays").alias("n_displays"))


def split_displays(spark: SparkSession, sf: str) -> DataFrame:
    return logs.split_logs(_flagged_log(spark, sf))["displays"].select(
        "item", "pos", "ts", "page_id", "mid", "is_new")


def _bounce(spark, sf, next_rule, emit):
    b = logs.bounce_visits(_page_log(spark, sf), C.BOUNCE_WITHIN_MS, next_rule, emit)
    return b.select(F.col("common.mid").alias("mid"), "ts", "event_id",
                    F.col("page.page_id").alias("page_id"))


def bounce_detail(spark: SparkSession, sf: str) -> DataFrame:
    return _bounce(spark, sf, "entry", "both")


def bounce_timeout_only(spark: SparkSession, sf: str) -> DataFrame:
    return _bounce(spark, sf, "non_entry", "timeout")


# ---- change-record path -------------------------------------------------------------
def _clean(spark, sf):
    text = P.change_log_text(table(spark, sf, "customer"),
                             table(spark, sf, "part"))
    return cdc.clean_changes(text)


def _with_latest_rules(spark, sf):
    rules = cdc.rules_in_force(C.rule_history(spark))
    return cdc.attach_rules(_clean(spark, sf), rules)


def cdc_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf).select(
        F.col("table").alias("source_table"), "type", "ts",
        F.size("data").alias("n_fields"))


def rule_route(spark: SparkSession, sf: str) -> DataFrame:
    projected = cdc.project_columns(_with_latest_rules(spark, sf))
    kept = cdc.with_branch(projected).filter(F.col("branch") != "dropped")
    return kept.select("source_table", "ts", F.col("operate_type").alias("op"),
                       "sink_type", "sink_table", F.size("data").alias("n_columns"))


def rule_asof(spark: SparkSession, sf: str) -> DataFrame:
    routed = cdc.attach_rules_asof(_clean(spark, sf), C.rule_history(spark))
    return routed.select("source_table", "ts", "op", "sink_type", "sink_table", "version")


def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    projected = cdc.project_columns(_with_latest_rules(spark, sf))
    return (projected.select("sink_table", "ts",
                             F.explode("data").alias("col_name", "col_value")))


def dim_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    projected = cdc.project_columns(_with_latest_rules(spark, sf))
    rows = dims.dimension_rows(cdc.route(projected)[S.SINK_TYPE_HBASE])
    snap = dims.upsert(None, rows)
    return (snap.select("sink_table", "pk", "seq",
                        F.explode("data").alias("col_name", "col_value")))


# ---- order path --------------------------------------------------------------------
def _orders(spark, sf):
    info = orders.with_time_fields(P.order_info(table(spark, sf, "orders")))
    detail = orders.with_time_fields(P.order_detail(table(spark, sf, "lineitem")),
                                     derive_date_hour=False)
    return info, detail


def _dims(spark, sf) -> dict[str, DataFrame]:
    customer, nation, part = (table(spark, sf, t) for t in ("customer", "nation", "part"))
    categories = P.category3_ids(part)
    return {
        S.DIM_USER_INFO: P.dim_user_info(customer),
        S.DIM_BASE_PROVINCE: P.dim_base_province(nation),
        S.DIM_SKU_INFO: P.dim_sku_info(part, categories),
        S.DIM_SPU_INFO: P.dim_spu_info(part),
        S.DIM_BASE_TRADEMARK: P.dim_base_trademark(part),
        S.DIM_BASE_CATEGORY3: P.dim_base_category3(categories),
    }


def order_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    info, detail = _orders(spark, sf)
    wide = orders.interval_join(info, detail, C.ORDER_BAND_MS, C.ORDER_BAND_MS)
    return wide.select("detail_id", "order_id", "sku_id", "order_price", "sku_num",
                       "province_id", "order_status", "user_id", "total_amount",
                       "split_total_amount", "create_time", "create_date", "create_hour")


def order_wide(spark: SparkSession, sf: str) -> DataFrame:
    info, detail = _orders(spark, sf)
    return orders.order_wide(info, detail, _dims(spark, sf), C.AS_OF,
                             C.ORDER_BAND_MS, C.ORDER_BAND_MS)


def dim_sku_flat(spark: SparkSession, sf: str) -> DataFrame:
    sku_spec = orders.order_wide_specs(_dims(spark, sf), C.AS_OF)[2]
    return orders.flatten_dimension(sku_spec).withColumnRenamed("dim_sku_name", "sku_name")


def raw_log_by_day(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.functions import scalar as fn
    text = P.app_log_text(_events(spark, sf))
    return (text.groupBy(fn.landing_day("value").alias("dt"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def order_wide_enrich_first(spark: SparkSession, sf: str) -> DataFrame:
    """The same wide record, dimensions joined to orders and details before
    the band join (the plan for non-selective bands)."""
    info, detail = _orders(spark, sf)
    return orders.order_wide(info, detail, _dims(spark, sf), C.AS_OF,
                             C.ORDER_BAND_MS, C.ORDER_BAND_MS, enrich_first=True)


def user_age(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.functions import scalar as fn
    u = P.dim_user_info(table(spark, sf, "customer"))
    return u.select(fn.to_long("ID").alias("user_id"), F.col("GENDER").alias("user_gender"),
                    F.col("BIRTHDAY").alias("birthday"),
                    fn.age_years("BIRTHDAY", C.AS_OF).alias("user_age"))


# ---- the same operators on records that hit their rare cases ----------------------------
def new_visitor_no_id(spark: SparkSession, sf: str) -> DataFrame:
    """First visits of records without an id, some of which came twice: records
    and new-visitor flags per visitor and time."""
    log = _flagged(P.open_log_text(_events(spark, sf)))
    return log.groupBy(F.col("common.mid").alias("mid"), "ts").agg(
        F.count("*").alias("n_records"),
        F.sum((F.col("common.is_new") == "1").cast("long")).alias("n_new"))


def log_whole_records(spark: SparkSession, sf: str) -> DataFrame:
    """What the detail layer writes: whole records, undeclared fields included."""
    log = _flagged(P.open_log_text(_events(spark, sf)))
    text = as_value(log)
    r = F.from_json("value", "common struct<mid string, uid string, is_new string, "
                    "ar struct<code string>>, page struct<item string>, err struct<no string>, "
                    "ts string")
    return text.select(F.size(F.json_object_keys("value")).alias("n_fields"), r.alias("r")).select(
        "n_fields", "r.common.mid", "r.common.uid", F.col("r.common.ar.code").alias("area"),
        F.col("r.page.item").alias("page_item"), F.col("r.err.no").alias("err_no"), "r.ts",
        F.col("r.common.is_new").isin("0", "1").alias("flagged"))


def display_whole_records(spark: SparkSession, sf: str) -> DataFrame:
    """Display records with all fields of the element and of ``common``."""
    log = logs.parse_app_log(P.open_log_text(_events(spark, sf)))
    text = logs.display_records(log.where("start is null and displays is not null"))
    r = F.from_json("value", "item string, pos string, display_type string, `order` string, "
                    "ts string, page_id string, mid string, uid string, ar struct<code string>")
    return text.select(r.alias("r")).select(
        "r.item", "r.pos", "r.display_type", "r.order", "r.ts", "r.page_id", "r.mid", "r.uid",
        F.col("r.ar.code").alias("area"))


def log_odd_records(spark: SparkSession, sf: str) -> DataFrame:
    """Whole records, as text, of legal JSON that parsing and writing would change."""
    return as_value(_flagged(P.odd_log_text(_events(spark, sf))))


def display_odd_records(spark: SparkSession, sf: str) -> DataFrame:
    """Display records, as text, of the same records."""
    log = _flagged(P.odd_log_text(_events(spark, sf)))
    return logs.display_records(log.where("start is null and displays is not null"))


def cdc_clean_flawed(spark: SparkSession, sf: str) -> DataFrame:
    clean = cdc.clean_changes(P.flawed_change_text(table(spark, sf, "customer")))
    return clean.select(F.col("table").alias("source_table"), "type", "ts",
                        F.size("data").alias("n_fields"))


def rule_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Where every cleaned change goes: a sink, ``dropped`` (a sink that is not
    known) or ``no_rule``."""
    text = P.change_log_text(*(table(spark, sf, t) for t in ("customer", "part"))).unionByName(
        P.supplier_changes(table(spark, sf, "supplier")).select(
            F.to_json(F.struct("*")).alias("value")))
    clean = cdc.clean_changes(text, ("insert", "update"))
    rules = cdc.rules_in_force(C.rule_history(spark))
    routed = cdc.with_branch(cdc.attach_rules(clean, rules, keep_all=True))
    return routed.groupBy("table", "op", "branch").agg(F.count("*").alias("n_records"))


def dim_upsert_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Newest row per key where keys have many versions, many of one instant."""
    text = P.order_driven_changes(table(spark, sf, "orders")).select(
        F.to_json(F.struct("*")).alias("value"))
    rules = cdc.rules_in_force(C.rule_history(spark))
    routed = cdc.project_columns(cdc.attach_rules(cdc.clean_changes(text), rules))
    rows = dims.dimension_rows(cdc.route(routed)[S.SINK_TYPE_HBASE], pos_col="xoffset")
    return dims.upsert(None, rows).select(
        "sink_table", "pk", "seq", "pos", F.explode("data").alias("col_name", "col_value"))


def order_wide_misses(spark: SparkSession, sf: str) -> DataFrame:
    """The wide record where dimension rows are missing, birthdays are blank and
    details carry a sku name of their own."""
    info, detail = _orders(spark, sf)
    detail = detail.withColumn("sku_name", F.concat(F.lit("own_"), F.col("sku_id")))
    d = _dims(spark, sf)
    user = d[S.DIM_USER_INFO]
    d[S.DIM_USER_INFO] = user.where("ID % 3 <> 0").withColumn(
        "BIRTHDAY", F.when(F.expr("ID % 4 = 0"), "").otherwise(F.col("BIRTHDAY")))
    d[S.DIM_SKU_INFO] = d[S.DIM_SKU_INFO].where("ID % 5 <> 0")
    d[S.DIM_BASE_TRADEMARK] = d[S.DIM_BASE_TRADEMARK].where("ID <> '11'")
    wide = orders.order_wide(info, detail, d, C.AS_OF, C.ORDER_BAND_MS, C.ORDER_BAND_MS)
    return wide.select("detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
                       "user_id", "user_age", "user_gender", "spu_name", "tm_name",
                       "category3_name", "province_name")


QUERIES: dict[str, Query] = {
    "daily_unique_visitor": daily_unique_visitor,
    "new_visitor_flag": new_visitor_flag,
    "split_start": split_start,
    "split_page": split_page,
    "split_displays": split_displays,
    "bounce_detail": bounce_detail,
    "bounce_timeout_only": bounce_timeout_only,
    "cdc_clean": cdc_clean,
    "rule_route": rule_route,
    "rule_asof": rule_asof,
    "project_columns": project_columns,
    "dim_upsert_latest": dim_upsert_latest,
    "order_interval_join": order_interval_join,
    "order_wide": order_wide,
    "order_wide_enrich_first": order_wide_enrich_first,
    "user_age": user_age,
    "dim_sku_flat": dim_sku_flat,
    "raw_log_by_day": raw_log_by_day,
    "new_visitor_no_id": new_visitor_no_id,
    "log_whole_records": log_whole_records,
    "display_whole_records": display_whole_records,
    "log_odd_records": log_odd_records,
    "display_odd_records": display_odd_records,
    "cdc_clean_flawed": cdc_clean_flawed,
    "rule_outcomes": rule_outcomes,
    "dim_upsert_versions": dim_upsert_versions,
    "order_wide_misses": order_wide_misses,
}
