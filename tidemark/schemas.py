"""Record shapes of the warehouse layers.

Raw app logs and change records are JSON text; they are parsed with these
explicit schemas (never inferred).  The change-record payload is truly
dynamic, so it is a ``MAP<STRING,STRING>``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- raw app log (ods_log) -------------------------------------------------
# The fields that the operators use.  A record may hold any others: its raw text
# travels along (``logs.RECORD``) and is what the outputs are made of.
COMMON = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("is_new", T.StringType()),
])
START = T.StructType([
    T.StructField("entry", T.StringType()),
    T.StructField("loading_time", T.DoubleType()),
])
PAGE = T.StructType([
    T.StructField("page_id", T.StringType()),
    T.StructField("last_page_id", T.StringType()),
    T.StructField("during_time", T.DoubleType()),
])
DISPLAY = T.StructType([
    T.StructField("item", T.StringType()),
    T.StructField("pos", T.IntegerType()),
])
APP_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("common", COMMON),
    T.StructField("start", START),
    T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("ts", T.LongType()),
])

# What a first visit is decided by.
VISIT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("common", T.StructType([T.StructField("mid", T.StringType())])),
    T.StructField("ts", T.LongType()),
])

# ---- database change record (ods_db) ---------------------------------------
CHANGE = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("xoffset", T.LongType()),     # position in the change log, where it has one
    T.StructField("data", T.MapType(T.StringType(), T.StringType())),
])

# ---- routing rule (all text, key (source_table, operate_type)) -------------
RULE_COLUMNS = ["source_table", "operate_type", "sink_type", "sink_table",
                "sink_columns", "sink_pk", "sink_extend"]
RULE = T.StructType([T.StructField(c, T.StringType()) for c in RULE_COLUMNS])
# change history of the rules table: one row per change, newest version wins
RULE_CHANGE = T.StructType(list(RULE.fields) + [
    T.StructField("op", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("rule_ts", T.LongType()),
])

# ---- typed order records: fixed record shapes --------------------------------
MONEY = T.DecimalType(16, 2)
ORDER_INFO = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("province_id", T.LongType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("total_amount", MONEY),
    T.StructField("activity_reduce_amount", MONEY),
    T.StructField("coupon_reduce_amount", MONEY),
    T.StructField("original_total_amount", MONEY),
    T.StructField("feight_fee", MONEY),
    T.StructField("expire_time", T.StringType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("operate_time", T.StringType()),
])
ORDER_DETAIL = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("order_price", MONEY),
    T.StructField("sku_num", T.LongType()),
    T.StructField("sku_name", T.StringType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("split_total_amount", MONEY),
    T.StructField("split_activity_amount", MONEY),
    T.StructField("split_coupon_amount", MONEY),
])

# Fixed record shape: the columns of the wide order record, in order.
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
    "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "expire_time", "create_time",
    "operate_time", "create_date", "create_hour", "province_name",
    "province_area_code", "province_iso_code", "province_3166_2_code",
    "user_age", "user_gender", "spu_id", "tm_id", "category3_id", "spu_name",
    "tm_name", "category3_name",
]

# ---- fixed values: topic and dimension table names ------------------------
TOPIC_ODS_LOG = "ods_log"
TOPIC_ODS_DB = "ods_db"
TOPIC_DWD_START = "dwd_start"
TOPIC_DWD_PAGE = "dwd_page"
TOPIC_DWD_DISPLAYS = "dwd_displays"
TOPIC_DWM_UV = "dwm_uv"
TOPIC_DWM_USER_JUMP_DETAIL = "dwm_user_jump_detail"
TOPIC_DWD_ORDER_INFO = "dwd_order_info"
TOPIC_DWD_ORDER_DETAIL = "dwd_order_detail"
TOPIC_DWM_ORDER_WIDE = "dwm_order_wide"

DIM_USER_INFO = "DIM_USER_INFO"
DIM_BASE_PROVINCE = "DIM_BASE_PROVINCE"
DIM_SKU_INFO = "DIM_SKU_INFO"
DIM_SPU_INFO = "DIM_SPU_INFO"
DIM_BASE_TRADEMARK = "DIM_BASE_TRADEMARK"
DIM_BASE_CATEGORY3 = "DIM_BASE_CATEGORY3"

SINK_TYPE_HBASE = "hbase"
SINK_TYPE_KAFKA = "kafka"
SINK_TYPE_CK = "clickhouse"
