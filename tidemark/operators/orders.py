"""Order wide layer: band join of orders with their details, snowflake
enrichment from dimension tables.

Scale notes
-----------
* The band join is an equi-join on the order id with the time band as a
  post-join predicate: both sides are hash-partitioned by order id (balanced
  keys), AQE splits a skewed order.
* Dimensions are joined *after* the band join, which is selective.
* The sku snowflake (sku -> spu, trademark, category3) is flattened on the
  dimension side first, so the fact rows meet one sku join instead of four.
* User and sku dimensions grow with the data: sort-merge joins (batch queries
  may find them small at run time; AQE is off in stateful streams).  Province,
  spu, trademark and category3 are broadcast after a check of their size, and
  shuffled where they are too large for it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import scalar as fn
from tidemark.operators.joins import broadcast_if_small
from tidemark.operators.logs import parse_json


# P2 / P3 ----------------------------------------------------------------------------
def with_time_fields(df: DataFrame, derive_date_hour: bool = True) -> DataFrame:
    """Derived fields computed when an order record is bound: ``create_ts``
    (epoch ms) and, for order info, ``create_date`` and ``create_hour``."""
    out = df.withColumn("create_ts", fn.create_ts("create_time"))
    if derive_date_hour:
        out = (out.withColumn("create_date", fn.create_date("create_time"))
               .withColumn("create_hour", fn.create_hour("create_time")))
    return out


def parse_order_info(text: DataFrame, value_col: str = "value") -> DataFrame:
    return with_time_fields(parse_json(text, S.ORDER_INFO, value_col, keep_corrupt=False))


def parse_order_detail(text: DataFrame, value_col: str = "value") -> DataFrame:
    return with_time_fields(parse_json(text, S.ORDER_DETAIL, value_col, keep_corrupt=False),
                            derive_date_hour=False)


# J1 / J11 -----------------------------------------------------------------------------
INFO_FIELDS = [f.name for f in S.ORDER_INFO
               if f.name not in ("id", "expire_time", "operate_time")] + ["create_date", "create_hour"]
DETAIL_FIELDS = [f.name for f in S.ORDER_DETAIL
                 if f.name not in ("id", "order_id", "create_time")]
NEVER_FILLED = {"expire_time": "string", "operate_time": "string",
                "split_feight_fee": "decimal(16,2)"}


def band_condition(info: DataFrame, detail: DataFrame, lower_ms: int, upper_ms: int):
    """``info.id = detail.order_id`` and the detail's time inside
    ``[info - lower, info + upper]``, both bounds inclusive."""
    return ((info["id"] == detail["order_id"])
            & (detail["create_ts"] >= info["create_ts"] - F.lit(lower_ms))
            & (detail["create_ts"] <= info["create_ts"] + F.lit(upper_ms)))


def interval_join(info: DataFrame, detail: DataFrame, lower_ms: int = 5000,
                  upper_ms: int = 5000) -> DataFrame:
    """Inner band join of order info and order detail, merged into the wide
    record (info fields, then detail fields; ``expire_time``,
    ``operate_time`` and ``split_feight_fee`` stay null as in the reference).
    Defaults are the reference's +-5 s; callers pass their band."""
    i = info.alias("i")
    d = detail.alias("d")
    joined = i.join(d, band_condition(i, d, lower_ms, upper_ms), "inner")
    return merge_wide(joined)


def merge_wide(joined: DataFrame, extra_info: list[str] = (),
               extra_detail: list[str] = ()) -> DataFrame:
    """Info fields then detail fields (plus already-enriched columns)."""
    cols = [F.col("d.id").alias("detail_id"), F.col("i.id").alias("order_id")]
    cols += [F.col(f"i.{c}").alias(c) for c in [*INFO_FIELDS, *extra_info]]
    cols += [F.col(f"d.{c}").alias(c) for c in [*DETAIL_FIELDS, *extra_detail]]
    cols += [F.lit(None).cast(t).alias(c) for c, t in NEVER_FILLED.items()]
    return joined.select(*cols)


# X2 / J2..J8 ----------------------------------------------------------------------------
@dataclass
class DimSpec:
    """One dimension of the enrichment: the table, the fact column that keys
    it, and output column -> dimension column (or Column expression)."""
    table: DataFrame
    fact_key: str
    outputs: dict
    dim_key: str = "ID"
    children: list["DimSpec"] = field(default_factory=list)
    small: bool = False         # does not grow with the data; its size is checked all the same


def _dim_side(spec: DimSpec) -> DataFrame:
    cols = [fn.to_long(F.col(spec.dim_key)).alias(spec.fact_key)]
    for out, src in spec.outputs.items():
        cols.append((F.col(src) if isinstance(src, str) else src).alias(out))
    side = spec.table.select(*cols)
    for child in spec.children:  # snowflake: flatten on the dimension side
        side = side.join(broadcast_if_small(_dim_side(child)), child.fact_key, "left")
    return side


def flatten_dimension(spec: DimSpec) -> DataFrame:
    """J5-J7 on the dimension side: a dimension joined with its children
    (e.g. sku with spu, trademark, category3), keyed by ``spec.fact_key``."""
    return _dim_side(spec)


def enrich(facts: DataFrame, specs: list[DimSpec]) -> DataFrame:
    """Left-join every dimension (with its flattened children) by key; a
    missing dimension row leaves nulls."""
    out = facts
    for spec in specs:
        side = broadcast_if_small(_dim_side(spec)) if spec.small else _dim_side(spec)
        clash = [c for c in side.columns if c != spec.fact_key and c in out.columns]
        out = out.drop(*clash).join(side, spec.fact_key, "left")
    return out


def order_wide_specs(dims: dict[str, DataFrame], as_of: str) -> list[DimSpec]:
    """The reference's six dimensions: user, province, sku -> (spu, trademark,
    category3).  ``dims`` is keyed by the dimension table names."""
    user = dims[S.DIM_USER_INFO]
    return [
        DimSpec(user, "user_id", {
            "user_gender": "GENDER",
            "user_age": fn.age_years("BIRTHDAY", as_of)}),
        DimSpec(dims[S.DIM_BASE_PROVINCE], "province_id", {
            "province_name": "NAME", "province_area_code": "AREA_CODE",
            "province_iso_code": "ISO_CODE", "province_3166_2_code": "ISO_3166_2"}, small=True),
        DimSpec(dims[S.DIM_SKU_INFO], "sku_id", {
            "dim_sku_name": "SKU_NAME",
            "spu_id": fn.to_long("SPU_ID"), "tm_id": fn.to_long("TM_ID"),
            "category3_id": fn.to_long("CATEGORY3_ID")},
            children=[
                DimSpec(dims[S.DIM_SPU_INFO], "spu_id", {"spu_name": "SPU_NAME"}),
                DimSpec(dims[S.DIM_BASE_TRADEMARK], "tm_id", {"tm_name": "TM_NAME"}),
                DimSpec(dims[S.DIM_BASE_CATEGORY3], "category3_id", {"category3_name": "NAME"}),
            ]),
    ]


def order_wide(info: DataFrame, detail: DataFrame, dims: dict[str, DataFrame],
               as_of: str, lower_ms: int = 5000, upper_ms: int = 5000,
               enrich_first: bool = False) -> DataFrame:
    """Band join and one pass filling the wide record.  The sku name of
    the dimension wins over the detail's own name; a miss keeps the detail's.

    ``enrich_first=False`` joins the dimensions to the band-join output: best
    when the band is selective (few details match).  ``True`` joins user and
    province to the orders and the sku chain to the details *before* the band
    join: when most details match (the usual case of real-time orders) the
    wide rows are then shuffled once (by order id) instead of three times.
    """
    user, province, sku = order_wide_specs(dims, as_of)
    if enrich_first:
        info_e = enrich(info, [user, province])
        detail_e = enrich(detail, [sku])
        extra_i = [c for c in info_e.columns if c not in info.columns]
        extra_d = [c for c in detail_e.columns if c not in detail.columns]
        i, d = info_e.alias("i"), detail_e.alias("d")
        wide = merge_wide(i.join(d, band_condition(i, d, lower_ms, upper_ms), "inner"),
                          extra_i, extra_d)
    else:
        wide = enrich(interval_join(info, detail, lower_ms, upper_ms), [user, province, sku])
    wide = wide.withColumn("sku_name", F.coalesce(F.col("dim_sku_name"), F.col("sku_name")))
    return wide.select(*S.ORDER_WIDE_COLUMNS)
