"""DuckDB SQL for every registered query, over the driver's parquet views.

Written independently of the Spark plans: where the Spark side uses skew-safe
aggregates and bucketed look-ups, the oracle uses the textbook window form
(``row_number``/``lead`` over the whole key).  Projections repeat those of
``tidemark.sources.projections``.
"""

from __future__ import annotations

from tidemark.plans import config as C

# ---- shared projections --------------------------------------------------------
PAGE_LOG = """
pl AS (
  SELECT event_id,
         CAST(user_id AS VARCHAR) AS mid,
         event_type AS page_id,
         CASE WHEN event_type IN ('view', 'signup') THEN NULL ELSE 'home' END AS last_page_id,
         epoch_us(ts) // 1000 AS ts,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS visit_date
  FROM events)"""

FLAGGED_LOG = """
fl AS (
  SELECT event_id,
         CAST(user_id AS VARCHAR) AS mid,
         epoch_us(ts) // 1000 AS ts,
         event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS n_disp,
         CASE WHEN row_number() OVER (PARTITION BY user_id
                                      ORDER BY epoch_us(ts) // 1000, event_id) = 1
              THEN '1' ELSE '0' END AS is_new
  FROM events)"""


def _bounce_sql(with_match: bool) -> str:
    match = " OR next_entry" if with_match else ""
    return f"""
WITH {PAGE_LOG},
x AS (
  SELECT *,
         (last_page_id IS NULL OR last_page_id = '') AS is_entry,
         lead(ts) OVER w AS next_ts,
         lead(last_page_id IS NULL OR last_page_id = '') OVER w AS next_entry
  FROM pl
  WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
SELECT mid, ts, event_id, page_id
FROM x
WHERE is_entry AND (next_ts IS NULL OR next_ts - ts >= {C.BOUNCE_WITHIN_MS}{match})
"""


# ---- change records ------------------------------------------------------------------
def _type_expr(key: str) -> str:
    return (f"CASE {key} % 4 WHEN 0 THEN 'bootstrap-insert' WHEN 1 THEN 'update' "
            f"ELSE 'insert' END")


CHANGE_KV = f"""
kv AS (
  SELECT 'customer' AS source_table, {_type_expr('c_custkey')} AS type,
         c_custkey * 1000 AS ts, t.col_name, t.col_value
  FROM customer, LATERAL (VALUES
      ('c_custkey', CAST(c_custkey AS VARCHAR)),
      ('c_name', c_name),
      ('c_nationkey', CAST(c_nationkey AS VARCHAR)),
      ('c_acctbal', CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR)),
      ('c_mktsegment', c_mktsegment)) AS t(col_name, col_value)
  UNION ALL
  SELECT 'part', {_type_expr('p_partkey')}, p_partkey * 1000, t.col_name, t.col_value
  FROM part, LATERAL (VALUES
      ('p_partkey', CAST(p_partkey AS VARCHAR)),
      ('p_name', p_name),
      ('p_brand', p_brand),
      ('p_type', p_type),
      ('p_size', CAST(p_size AS VARCHAR)),
      ('p_retailprice', CAST(CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR))) AS t(col_name, col_value)),
clean_kv AS (SELECT * FROM kv WHERE type LIKE '%insert%'),
clean AS (
  SELECT source_table, type, replace(type, 'bootstrap-', '') AS op, ts,
         CAST(count(*) AS INTEGER) AS n_fields
  FROM clean_kv GROUP BY ALL)"""

LATEST_RULES = f"""
rh AS (SELECT * FROM {C.rule_history_sql()}),
rules AS (
  SELECT * FROM rh WHERE op IN ('insert', 'update_after')
  QUALIFY row_number() OVER (PARTITION BY source_table, operate_type
                             ORDER BY version DESC) = 1)"""

PROJECTED = """
matched AS (
  SELECT c.source_table, c.ts, c.op, r.sink_type, r.sink_table, r.sink_columns, r.sink_pk
  FROM clean c JOIN rules r
    ON c.source_table = r.source_table AND c.op = r.operate_type),
projected_kv AS (
  SELECT m.*, k.col_name, k.col_value
  FROM matched m JOIN clean_kv k
    ON k.source_table = m.source_table AND k.ts = m.ts
  WHERE m.sink_columns IS NULL
     OR list_contains(string_split(m.sink_columns, ','), k.col_name))"""


# ---- orders ------------------------------------------------------------------------------
ORDERS = """
oi AS (
  SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time
  FROM orders),
oi2 AS (
  SELECT *, substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour,
         epoch_ms(strptime(create_time, '%Y-%m-%d %H:%M:%S')) AS create_ts
  FROM oi),
od AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2))
              * (1 - CAST(l_discount AS DECIMAL(16,2))) AS DECIMAL(16,2)) AS split_total_amount
  FROM lineitem),
od2 AS (SELECT *, epoch_ms(strptime(create_time, '%Y-%m-%d %H:%M:%S')) AS create_ts FROM od),
wide AS (
  SELECT d.id AS detail_id, i.id AS order_id, d.sku_id, d.order_price, d.sku_num,
         i.province_id, i.order_status, i.user_id, i.total_amount, d.split_total_amount,
         i.create_time, i.create_date, i.create_hour
  FROM oi2 i JOIN od2 d
    ON i.id = d.order_id
   AND d.create_ts BETWEEN i.create_ts - {band} AND i.create_ts + {band})""".replace(
    "{band}", str(C.ORDER_BAND_MS))

USER_DIM = """
user_dim AS (
  SELECT CAST(c_custkey AS VARCHAR) AS ID,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS GENDER,
         strftime(DATE '1960-01-01' + CAST(c_custkey * 37 % 15000 AS INTEGER), '%Y-%m-%d') AS BIRTHDAY
  FROM customer)"""

AGE_EXPR = (f"CAST((epoch_ms(TIMESTAMP '{C.AS_OF}') - epoch_ms(CAST(BIRTHDAY AS TIMESTAMP)))"
            f" // 31536000000 AS INTEGER)")

DIMS = USER_DIM + """,
prov AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS ID, n_name AS NAME, CAST(n_regionkey AS VARCHAR) AS AREA_CODE,
         'NK' || CAST(n_nationkey AS VARCHAR) AS ISO_CODE, 'NK-' || CAST(n_nationkey AS VARCHAR) AS ISO_3166_2
  FROM nation),
c3 AS (
  SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) AS VARCHAR) AS CATEGORY3_ID
  FROM (SELECT DISTINCT p_type FROM part)),
sku AS (
  SELECT CAST(p_partkey AS VARCHAR) AS ID, p_name AS SKU_NAME,
         CAST(p_partkey % 100 AS VARCHAR) AS SPU_ID,
         regexp_extract(p_brand, '([0-9]+)', 1) AS TM_ID, c3.CATEGORY3_ID
  FROM part LEFT JOIN c3 USING (p_type)),
spu AS (
  SELECT DISTINCT CAST(p_partkey % 100 AS VARCHAR) AS ID,
         'spu_' || CAST(p_partkey % 100 AS VARCHAR) AS SPU_NAME FROM part),
tm AS (SELECT DISTINCT regexp_extract(p_brand, '([0-9]+)', 1) AS ID, p_brand AS TM_NAME FROM part),
cat AS (SELECT CATEGORY3_ID AS ID, p_type AS NAME FROM c3)"""


SQL: dict[str, str] = {
    "daily_unique_visitor": f"""
WITH {PAGE_LOG}
SELECT mid, visit_date, ts, event_id, page_id, last_page_id
FROM pl
QUALIFY row_number() OVER (PARTITION BY mid, visit_date ORDER BY ts, event_id) = 1
""",
    "new_visitor_flag": f"""
WITH {FLAGGED_LOG}
SELECT event_id, mid, ts, is_new FROM fl
""",
    "split_start": f"""
WITH {FLAGGED_LOG}
SELECT event_id, mid, is_new, ts, event_type AS entry, value AS loading_time
FROM fl WHERE event_type = 'signup'
""",
    "split_page": f"""
WITH {FLAGGED_LOG}
SELECT event_id, mid, is_new, ts, event_type AS page_id,
       CASE WHEN event_type = 'view' THEN NULL ELSE 'home' END AS last_page_id,
       value AS during_time, CAST(n_disp AS INTEGER) AS n_displays
FROM fl WHERE event_type <> 'signup'
""",
    "split_displays": f"""
WITH {FLAGGED_LOG}
SELECT CAST(event_id * 10 + i + 1 AS VARCHAR) AS item, CAST(i + 1 AS INTEGER) AS pos,
       ts, event_type AS page_id, mid, is_new
FROM fl, unnest(range(n_disp)) AS r(i)
WHERE event_type <> 'signup'
""",
    "bounce_detail": _bounce_sql(with_match=True),
    "bounce_timeout_only": _bounce_sql(with_match=False),
    "cdc_clean": f"""
WITH {CHANGE_KV}
SELECT source_table, type, ts, n_fields FROM clean
""",
    "rule_route": f"""
WITH {CHANGE_KV}, {LATEST_RULES}, {PROJECTED}
SELECT source_table, ts, op, sink_type, sink_table, CAST(count(*) AS INTEGER) AS n_columns
FROM projected_kv
WHERE sink_type IN ('kafka', 'hbase')
GROUP BY ALL
""",
    "rule_asof": f"""
WITH {CHANGE_KV}, rh AS (SELECT * FROM {C.rule_history_sql()})
SELECT c.source_table, c.ts, c.op, r.sink_type, r.sink_table, r.version
FROM clean c JOIN rh r
  ON c.source_table = r.source_table AND c.op = r.operate_type
 AND r.op IN ('insert', 'update_after') AND r.rule_ts <= c.ts
QUALIFY row_number() OVER (PARTITION BY c.source_table, c.ts
                           ORDER BY r.rule_ts DESC, r.version DESC) = 1
""",
    "project_columns": f"""
WITH {CHANGE_KV}, {LATEST_RULES}, {PROJECTED}
SELECT sink_table, ts, col_name, col_value FROM projected_kv
""",
    "dim_upsert_latest": f"""
WITH {CHANGE_KV}, {LATEST_RULES}, {PROJECTED},
hb AS (SELECT * FROM matched WHERE sink_type = 'hbase'),
latest AS (
  SELECT hb.*, k.col_value AS pk
  FROM hb JOIN clean_kv k
    ON k.source_table = hb.source_table AND k.ts = hb.ts
   AND k.col_name = coalesce(hb.sink_pk, 'id')
  QUALIFY row_number() OVER (PARTITION BY hb.sink_table, k.col_value ORDER BY hb.ts DESC) = 1),
cols AS (
  SELECT l.*, unnest(string_split(l.sink_columns, ',')) AS col_name FROM latest l)
SELECT c.sink_table, c.pk, c.ts AS seq, upper(c.col_name) AS col_name,
       coalesce(k.col_value, '') AS col_value
FROM cols c LEFT JOIN clean_kv k
  ON k.source_table = c.source_table AND k.ts = c.ts AND k.col_name = c.col_name
""",
    "order_interval_join": f"""
WITH {ORDERS}
SELECT * FROM wide
""",
    "order_wide": f"""
WITH {ORDERS}, {DIMS}
SELECT w.detail_id, w.order_id, w.sku_id, w.order_price, w.sku_num,
       coalesce(s.SKU_NAME, CAST(NULL AS VARCHAR)) AS sku_name,
       w.province_id, w.order_status, w.user_id, w.total_amount,
       CAST(NULL AS DECIMAL(16,2)) AS activity_reduce_amount,
       CAST(NULL AS DECIMAL(16,2)) AS coupon_reduce_amount,
       CAST(NULL AS DECIMAL(16,2)) AS original_total_amount,
       CAST(NULL AS DECIMAL(16,2)) AS feight_fee,
       CAST(NULL AS DECIMAL(16,2)) AS split_feight_fee,
       CAST(NULL AS DECIMAL(16,2)) AS split_activity_amount,
       CAST(NULL AS DECIMAL(16,2)) AS split_coupon_amount,
       w.split_total_amount,
       CAST(NULL AS VARCHAR) AS expire_time, w.create_time, CAST(NULL AS VARCHAR) AS operate_time,
       w.create_date, w.create_hour,
       p.NAME AS province_name, p.AREA_CODE AS province_area_code,
       p.ISO_CODE AS province_iso_code, p.ISO_3166_2 AS province_3166_2_code,
       {AGE_EXPR.replace('BIRTHDAY', 'u.BIRTHDAY')} AS user_age, u.GENDER AS user_gender,
       CAST(s.SPU_ID AS BIGINT) AS spu_id, CAST(s.TM_ID AS BIGINT) AS tm_id,
       CAST(s.CATEGORY3_ID AS BIGINT) AS category3_id,
       sp.SPU_NAME AS spu_name, t.TM_NAME AS tm_name, ct.NAME AS category3_name
FROM wide w
LEFT JOIN user_dim u ON CAST(u.ID AS BIGINT) = w.user_id
LEFT JOIN prov p ON CAST(p.ID AS BIGINT) = w.province_id
LEFT JOIN sku s ON CAST(s.ID AS BIGINT) = w.sku_id
LEFT JOIN spu sp ON sp.ID = s.SPU_ID
LEFT JOIN tm t ON t.ID = s.TM_ID
LEFT JOIN cat ct ON ct.ID = s.CATEGORY3_ID
""",
    "dim_sku_flat": f"""
WITH {DIMS}
SELECT CAST(s.ID AS BIGINT) AS sku_id, s.SKU_NAME AS sku_name,
       CAST(s.SPU_ID AS BIGINT) AS spu_id, CAST(s.TM_ID AS BIGINT) AS tm_id,
       CAST(s.CATEGORY3_ID AS BIGINT) AS category3_id,
       sp.SPU_NAME AS spu_name, t.TM_NAME AS tm_name, ct.NAME AS category3_name
FROM sku s
LEFT JOIN spu sp ON CAST(sp.ID AS BIGINT) = CAST(s.SPU_ID AS BIGINT)
LEFT JOIN tm t ON CAST(t.ID AS BIGINT) = CAST(s.TM_ID AS BIGINT)
LEFT JOIN cat ct ON CAST(ct.ID AS BIGINT) = CAST(s.CATEGORY3_ID AS BIGINT)
""",
    "raw_log_by_day": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n_records
FROM events GROUP BY 1
""",
    "user_age": f"""
WITH {USER_DIM}
SELECT CAST(ID AS BIGINT) AS user_id, GENDER AS user_gender, BIRTHDAY AS birthday,
       {AGE_EXPR} AS user_age
FROM user_dim
""",
}
SQL["order_wide_enrich_first"] = SQL["order_wide"]

# ---- rare cases ---------------------------------------------------------------------
OPEN_LOG = """
ol AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, epoch_us(ts) // 1000 AS ts, event_type, n_disp
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS n_disp FROM events),
       unnest(range(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)) AS again(i))"""

ODD_LOG = f"""
{FLAGGED_LOG},
o AS (
  SELECT *, '"uid":1.50,' AS head, CAST(event_id AS VARCHAR) AS id,
         CASE event_id % 3 WHEN 0 THEN '"is_new":"9","is_new" :"' || is_new || '",'
                           WHEN 1 THEN ''
                           ELSE '"is\\u005fnew": "' || is_new || '",' END AS claim,
         CASE event_id % 3 WHEN 1 THEN '"is_new":"' || is_new || '",' ELSE '' END AS added,
         '"mid":"' || mid || '","uid":' || event_id AS tail
  FROM fl)"""

SQL |= {
    "log_odd_records": f"""
WITH {ODD_LOG},
d AS (
  SELECT event_id, string_agg('{{"item":"' || i || '","n":1.10, "item":"' || i
                              || '!","ts":5,"q":[{{"a":"]}}"}}]}}', ' , ' ORDER BY i) AS shown
  FROM (SELECT event_id, event_id * 10 + unnest(range(n_disp)) + 1 AS i FROM fl) GROUP BY event_id)
SELECT '{{"k":1,"big":1e400,"event_id":' || id || ',"common":{{"mid":"other","is_new":"7"}}, '
       || CASE WHEN event_type = 'signup' THEN '"start" : {{"entry":"e\\"{{","v":1e400}},'
               ELSE '"page":{{"page_id":"x","z":{{}},"page_id":"' || event_type || '"}},' END
       || '"displays":[' || coalesce(shown, '') || '],"ts":' || ts || ',"common" : {{' || added || head
       || claim || tail || '}} ,"k":{{"b":0.10,"b":[]}}}}' AS value
FROM o LEFT JOIN d USING (event_id)
""",
    "display_odd_records": f"""
WITH {ODD_LOG}
SELECT '{{"item":"' || i || '","n":1.10, "item":"' || i || '!","q":[{{"a":"]}}"}}],"ts":' || ts
       || ',"page_id":"' || event_type || '",' || added || head || claim || tail || '}}' AS value
FROM (SELECT *, event_id * 10 + unnest(range(n_disp)) + 1 AS i FROM o WHERE event_type <> 'signup')
""",
    "new_visitor_no_id": f"""
WITH {OPEN_LOG}
SELECT mid, ts, count(*) AS n_records,
       CASE WHEN ts = min(ts) OVER (PARTITION BY mid) THEN 1 ELSE 0 END::BIGINT AS n_new
FROM ol GROUP BY mid, ts
""",
    "log_whole_records": f"""
WITH {OPEN_LOG}
SELECT mid, CAST(event_id * 3 AS VARCHAR) AS uid, 'area_' || mid AS area,
       CASE WHEN event_type <> 'signup' THEN CAST(event_id AS VARCHAR) END AS page_item,
       CAST(event_id % 7 AS VARCHAR) AS err_no, CAST(ts AS VARCHAR) AS ts,
       5 AS n_fields, true AS flagged
FROM ol
""",
    "display_whole_records": f"""
WITH {OPEN_LOG}
SELECT CAST(event_id * 10 + i + 1 AS VARCHAR) AS item, CAST(i + 1 AS VARCHAR) AS pos,
       'promotion' AS display_type, CAST((i + 1) * 2 AS VARCHAR) AS "order",
       CAST(ts AS VARCHAR) AS ts, event_type AS page_id, mid,
       CAST(event_id * 3 AS VARCHAR) AS uid, 'area_' || mid AS area
FROM ol, unnest(range(n_disp)) AS r(i)
WHERE event_type <> 'signup'
""",
    "cdc_clean_flawed": """
SELECT 'customer' AS source_table, 'insert' AS type, c_custkey AS ts, 2 AS n_fields
FROM customer WHERE c_custkey % 7 IN (5, 6)
""",
    "rule_outcomes": f"""
WITH {LATEST_RULES},
c AS (
  SELECT 'customer' AS tbl, {_type_expr('c_custkey')} AS type FROM customer
  UNION ALL SELECT 'part', {_type_expr('p_partkey')} FROM part
  UNION ALL SELECT 'supplier', {_type_expr('s_suppkey')} FROM supplier),
o AS (SELECT tbl, replace(type, 'bootstrap-', '') AS op FROM c)
SELECT tbl AS "table", o.op AS op,
       CASE WHEN r.source_table IS NULL THEN 'no_rule'
            WHEN r.sink_type IN ('kafka', 'hbase') THEN r.sink_type ELSE 'dropped' END AS branch,
       count(*) AS n_records
FROM o LEFT JOIN rules r ON r.source_table = tbl AND r.operate_type = o.op
GROUP BY ALL
""",
    "dim_upsert_versions": """
WITH v AS (
  SELECT o_custkey, o_orderkey, o_orderkey % 3 * 1000 AS seq, o_orderstatus
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey
                             ORDER BY o_orderkey % 3 DESC, o_orderkey DESC) = 1)
SELECT 'dim_user_info' AS sink_table, CAST(o_custkey AS VARCHAR) AS pk, seq, o_orderkey AS pos,
       t.col_name, t.col_value
FROM v, LATERAL (VALUES
    ('C_CUSTKEY', CAST(o_custkey AS VARCHAR)),
    ('C_NAME', 'order_' || CAST(o_orderkey AS VARCHAR)),
    ('C_NATIONKEY', CASE WHEN o_orderkey % 5 <> 0 THEN '7' ELSE '' END),
    ('C_MKTSEGMENT', o_orderstatus)) AS t(col_name, col_value)
""",
    "order_wide_misses": f"""
WITH {ORDERS}, {DIMS}
SELECT w.detail_id, w.order_id, w.sku_id, w.order_price, w.sku_num,
       coalesce(s.SKU_NAME, 'own_' || CAST(w.sku_id AS VARCHAR)) AS sku_name,
       w.user_id,
       CASE WHEN w.user_id % 4 <> 0
            THEN {AGE_EXPR.replace('BIRTHDAY', 'u.BIRTHDAY')} END AS user_age,
       u.GENDER AS user_gender, sp.SPU_NAME AS spu_name, t.TM_NAME AS tm_name,
       ct.NAME AS category3_name, p.NAME AS province_name
FROM wide w
LEFT JOIN user_dim u ON CAST(u.ID AS BIGINT) = w.user_id AND w.user_id % 3 <> 0
LEFT JOIN prov p ON CAST(p.ID AS BIGINT) = w.province_id
LEFT JOIN sku s ON CAST(s.ID AS BIGINT) = w.sku_id AND w.sku_id % 5 <> 0
LEFT JOIN spu sp ON sp.ID = s.SPU_ID
LEFT JOIN tm t ON t.ID = s.TM_ID AND t.ID <> '11'
LEFT JOIN cat ct ON ct.ID = s.CATEGORY3_ID
""",
}

# ---- streaming jobs, read back ----------------------------------------------------------
SQL |= {
    "stream_log_detail": f"""
WITH {OPEN_LOG},
f AS (SELECT *, min(ts) OVER (PARTITION BY mid) AS first_ts FROM ol)
SELECT mid, ts, CAST(event_id * 3 AS VARCHAR) AS uid, 'area_' || mid AS area,
       CAST(event_id AS VARCHAR) AS page_item, CAST(event_id % 7 AS VARCHAR) AS err_no,
       count(*) AS n_records, max(CASE WHEN ts = first_ts THEN 1 ELSE 0 END)::BIGINT AS n_new
FROM f WHERE event_type <> 'signup' GROUP BY mid, ts, event_id
""",
    "stream_log_outputs": f"""
WITH {OPEN_LOG}
SELECT 'dwd_start' AS topic, count(*) AS n_records FROM ol WHERE event_type = 'signup'
UNION ALL SELECT 'dwd_page', count(*) FROM ol WHERE event_type <> 'signup'
UNION ALL SELECT 'dwd_displays', CAST(sum(n_disp) AS BIGINT) FROM ol WHERE event_type <> 'signup'
UNION ALL SELECT 'ods_log_quarantine', 1
""",
    "stream_late_rows": f"""
WITH {OPEN_LOG}
SELECT 'dropped' AS what, b AS batch_id,
       (SELECT CASE WHEN b = 2 THEN count(*) ELSE 0 END FROM ol WHERE event_id % 10 = 0) AS n_rows
FROM (SELECT unnest([0, 1, 2])::BIGINT AS b)
UNION ALL SELECT 'late pages written', NULL, 0
""",
    "stream_unique_visitor": SQL["daily_unique_visitor"],
    "stream_bounce": SQL["bounce_detail"],
    "stream_bounce_timeout": SQL["bounce_timeout_only"],
    "stream_db_topics": f"""
SELECT sink_table, ts, col_name, col_value
FROM ({SQL["project_columns"]}) WHERE sink_table = 'dwd_part'
""",
    "stream_raw_landing": SQL["raw_log_by_day"],
    "stream_order_wide": f"""
SELECT detail_id, order_id, sku_id, sku_num, sku_name, user_id, user_age, user_gender,
       province_name, spu_name, tm_name, category3_name, create_date
FROM ({SQL["order_wide"]})
""",
}
SQL["stream_dimension_store"] = f"""
SELECT max(CASE WHEN col_name = 'C_CUSTKEY' THEN col_value END) AS "C_CUSTKEY",
       max(CASE WHEN col_name = 'C_NAME' THEN col_value END) AS "C_NAME",
       max(CASE WHEN col_name = 'C_NATIONKEY' THEN col_value END) AS "C_NATIONKEY",
       max(CASE WHEN col_name = 'C_MKTSEGMENT' THEN col_value END) AS "C_MKTSEGMENT"
FROM ({SQL["dim_upsert_versions"]}) GROUP BY pk
"""
