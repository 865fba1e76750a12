"""Dimension maintenance: rows for rule-defined tables, newest row per key.

A dimension record is stored with all-text columns named in upper case,
listed by the rule (``sink_columns``), keyed by ``sink_pk`` (default ``id``);
a column missing from the record is stored as ``''``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalar as fn

DEFAULT_PK = "id"


# S6 --------------------------------------------------------------------------------
def table_schema(sink_columns: str, sink_pk: str | None = None) -> T.StructType:
    """All-text schema of a rule's sink table; the key column comes first."""
    cols = list(dict.fromkeys(sink_columns.split(",")))
    pk = sink_pk or DEFAULT_PK
    if pk not in cols:
        raise ValueError(f"key column {pk!r} is not among the sink columns {sink_columns!r}")
    ordered = [pk] + [c for c in cols if c != pk]
    return T.StructType([T.StructField(c.upper(), T.StringType()) for c in ordered])


def union_rules(rules: list[tuple[str, str, str | None]]) -> dict[str, tuple[str, str]]:
    """``{sink_table: (columns, key)}`` of ``(sink_table, sink_columns, sink_pk)``
    rules: the columns of all rules that write a table, in order of appearance.
    Rules that disagree on the key, or miss it, are refused."""
    out: dict[str, tuple[str, str]] = {}
    for name, columns, pk in sorted(rules, key=lambda r: (r[0], r[1])):
        table_schema(columns, pk)
        before, key = out.get(name, ("", pk or DEFAULT_PK))
        if key != (pk or DEFAULT_PK):
            raise ValueError(f"rules of {name} name different keys: {key}, {pk or DEFAULT_PK}")
        both = dict.fromkeys([c for c in before.split(",") if c] + columns.split(","))
        out[name] = (",".join(both), key)
    return out


def storable(rules: list[tuple[str, str, str | None]]) -> tuple[dict[str, tuple[str, str]], list[str]]:
    """``union_rules`` of the rules that it accepts, and the others, each as its table,
    columns and key joined by line ends.  Of rules that name different keys for a
    table, those that agree with the first stay."""
    good, bad = [], []
    for rule in sorted(rules, key=lambda r: (r[0], r[1])):
        try:
            union_rules([*good, rule])
            good.append(rule)
        except ValueError:
            bad.append("\n".join((rule[0], rule[1], rule[2] or DEFAULT_PK)))
    return union_rules(good), bad


# P12 / T9 ----------------------------------------------------------------------------
def dimension_rows(routed: DataFrame, seq_col: str = "ts",
                   pos_col: str | None = None) -> DataFrame:
    """Routed records -> upsert rows ``(sink_table, pk, seq, pos, data)``:
    ``data`` covers exactly the rule's columns, keys upper-cased, nulls as
    ``''``.  ``pos`` decides between changes of the same instant: the record's
    position in its source (``pos_col``), else its place in the frame.  A rule
    whose key is not among its columns ends the job."""
    cols = fn.split_list("sink_columns")
    pk_name = F.coalesce(F.col("sink_pk"), F.lit(DEFAULT_PK))
    full = F.map_from_arrays(
        cols, F.transform(cols, lambda c: fn.null_to_empty(F.col("data")[c])))
    pk = F.when(F.array_contains(cols, pk_name), F.col("data")[pk_name]).otherwise(F.raise_error(
        F.concat(F.lit("rule without its key column: "), F.col("sink_table"))).cast("string"))
    place = F.monotonically_increasing_id()
    pos = place if pos_col is None else F.coalesce(F.col(pos_col), place)
    return routed.select(
        F.col("sink_table"), pk.alias("pk"), F.col(seq_col).alias("seq"), pos.alias("pos"),
        fn.upper_keys(full).alias("data"))


# A5 ----------------------------------------------------------------------------------
def latest_per_key(df: DataFrame, key_cols: list[str], seq_col: str,
                   pos_col: str) -> DataFrame:
    """Newest row of every (non-null) key: largest ``seq``, then largest ``pos``
    (last write wins), of rows equal in both any one.

    A maximum of a packed fixed-size key (hash aggregate, combined before the
    shuffle, so a hot key costs one row per map task) joined back on (key,
    packed key); whole rows move once, and equal ones are counted through where
    they are."""
    own = df.withColumn("_at", fn.order_key(
        F.coalesce(F.col(seq_col), F.lit(-(10 ** 16))), F.col(pos_col)))
    top = own.groupBy(*key_cols).agg(F.max("_at").alias("_at"))
    same = Window.partitionBy(*key_cols, "_at").rowsBetween(Window.unboundedPreceding, 0)
    return (own.join(top, [*key_cols, "_at"]).withColumn("_nth", F.count(F.lit(1)).over(same))
            .where("_nth = 1").select(*df.columns))


def latest_per_column(df: DataFrame, key: str, seq_col: str, pos_col: str) -> DataFrame:
    """One row per key with, for every column, its newest value that is not null
    (null: the change did not carry the column); ``seq`` and ``pos`` of the
    newest change."""
    at = fn.order_key(F.coalesce(F.col(seq_col), F.lit(-(10 ** 16))), F.col(pos_col))
    own = df.withColumn("_at", at)
    rest = [c for c in df.columns if c not in (key, seq_col, pos_col)]
    return own.groupBy(key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in rest],
        F.max_by(seq_col, "_at").alias(seq_col), F.max_by(pos_col, "_at").alias(pos_col))


# S5 ----------------------------------------------------------------------------------
def upsert(current: DataFrame | None, changes: DataFrame,
           key_cols: tuple[str, ...] = ("sink_table", "pk"),
           seq_col: str = "seq", pos_col: str = "pos") -> DataFrame:
    """New snapshot of a dimension table: current rows and upsert rows
    together, the newest per key."""
    both = changes if current is None else current.unionByName(changes)
    return latest_per_key(both, list(key_cols), seq_col, pos_col)
