"""Parameters of the registered queries and the routing-rule changelog.

The reference's durations (5 s window, 5 s pattern band, +-5 s join band,
3 s out-of-order allowance) are the library defaults.  The test tables have
events hours apart and order/ship dates years apart, so the registered
queries pass larger values; they are parameters, never hidden constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas as S

# Reference defaults (milliseconds).
WINDOW_MS = 5_000
PATTERN_WITHIN_MS = 5_000
JOIN_BAND_MS = 5_000
OUT_OF_ORDER_MS = 3_000

# Values used by the registered queries on the driver tables.
BOUNCE_WITHIN_MS = 6 * 60 * 60 * 1000          # 6 h
ORDER_BAND_MS = 30 * 24 * 60 * 60 * 1000       # +-30 days
LATE_CUT_MS = 1_705_276_800_000                # 2024-01-15: between two parts of the events
AS_OF = "2024-01-01 00:00:00"                  # age reference instant

# Routing-rule changelog: the rules table as change rows (rule columns, op,
# version, rule_ts in ms).  Newest added version per (source_table,
# operate_type) is in force; retraction rows are ignored.
RULE_HISTORY = [
    ("customer", "insert", "hbase", "dim_user_info", "c_custkey,c_name", "c_custkey", None,
     "insert", 1, 0),
    ("part", "insert", "hbase", "dim_sku_info", "p_partkey,p_name", "p_partkey", None,
     "insert", 2, 0),
    ("customer", "update", "clickhouse", "ads_user", "c_custkey", None, None,
     "insert", 3, 0),
    ("customer", "insert", "hbase", "dim_user_info", "c_custkey,c_name", "c_custkey", None,
     "update_before", 4, 400_000),
    ("customer", "insert", "hbase", "dim_user_info",
     "c_custkey,c_name,c_nationkey,c_mktsegment", "c_custkey", None,
     "update_after", 5, 400_000),
    ("part", "insert", "hbase", "dim_sku_info", "p_partkey,p_name", "p_partkey", None,
     "update_before", 6, 900_000),
    ("part", "insert", "kafka", "dwd_part",
     "p_partkey,p_name,p_brand,p_type,p_retailprice", None, None,
     "update_after", 7, 900_000),
    ("part", "insert", "kafka", "dwd_part",
     "p_partkey,p_name,p_brand,p_type,p_retailprice", None, None,
     "delete", 8, 1_500_000),
]


def rule_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULE_HISTORY, S.RULE_CHANGE)


def rule_history_sql() -> str:
    """The same changelog as an SQL VALUES list (for the DuckDB oracle)."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v} AS BIGINT)"
    rows = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in RULE_HISTORY)
    cols = ", ".join(S.RULE_COLUMNS + ["op", "version", "rule_ts"])
    return f"(VALUES\n    {rows}\n) AS rh({cols})"
