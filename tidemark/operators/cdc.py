"""Database change records: clean, match routing rules, project, route.

Scale notes
-----------
Change records are keyed by (table, operation) — a handful of keys, so a
hash shuffle on them would put whole tables into single tasks.  Rules are
therefore never shuffled against the data: the rules side is configuration,
its size is checked and it is broadcast (stream–static join in streams), and
the data keeps its input partitioning.  The per-table fan-out is a
partitioned write, not a repartition by table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions import scalar as fn
from tidemark.operators.joins import checked_broadcast
from tidemark.operators.logs import parse_where

RULE_KEY = ["source_table", "operate_type"]
# changelog kinds that add a row (retractions and deletes do not)
ADD_KINDS = ("insert", "update_after")


# P4 / P1 ---------------------------------------------------------------------------
def clean_changes(text: DataFrame, ops: tuple[str, ...] = ("insert",),
                  value_col: str = "value") -> DataFrame:
    """Raw ``ods_db`` text -> change records that pass the cleaning filter:
    ``database``, ``table``, ``type``, ``data`` present, ``type`` contains one
    of ``ops`` and the text of ``data`` is longer than 10 characters."""
    data_text = F.get_json_object(F.col(value_col), "$.data")
    rec = F.struct(F.from_json(F.col(value_col), S.CHANGE).alias("r"),
                   F.length(data_text).alias("data_len"))

    def keep(x: Column) -> Column:
        r = x["r"]
        op_ok = F.lit(False)
        for op in ops:
            op_ok = op_ok | r["type"].contains(op)
        return (r["database"].isNotNull() & r["table"].isNotNull() & r["type"].isNotNull()
                & r["data"].isNotNull() & op_ok & (x["data_len"] > 10))
    return parse_where(text, rec, keep).select("r.*")


# P5 ----------------------------------------------------------------------------------
def with_op(changes: DataFrame) -> DataFrame:
    """Operation without the ``bootstrap-`` prefix: the rule-key half."""
    return changes.withColumn("op", fn.strip_bootstrap("type"))


# P10 / A6 ------------------------------------------------------------------------------
def rule_additions(history: DataFrame) -> DataFrame:
    """Rows of the rules changelog that add a rule; retractions are dropped,
    so a deleted rule stays in force (the reference behaves the same)."""
    return history.filter(F.col("op").isin(*ADD_KINDS))


def rules_in_force(history: DataFrame) -> DataFrame:
    """Newest added version of every rule key (``put`` overwrites)."""
    added = rule_additions(history)
    newest = added.groupBy(*RULE_KEY).agg(F.max("version").alias("version"))
    return added.join(newest, [*RULE_KEY, "version"]).select(*S.RULE_COLUMNS, "version")


def rule_intervals(history: DataFrame) -> DataFrame:
    """Every added rule version with the event-time band in which it is in
    force: ``[valid_from, valid_to)``, ``valid_to`` null = open.  Versions
    with the same ``rule_ts`` leave only the newest one a non-empty band.
    The window runs over the rules changelog (configuration-sized)."""
    w = Window.partitionBy(*RULE_KEY).orderBy("rule_ts", "version")
    return (rule_additions(history)
            .withColumn("valid_from", F.col("rule_ts"))
            .withColumn("valid_to", F.lead("rule_ts").over(w))
            .drop("op"))


# J9 --------------------------------------------------------------------------------------
def attach_rules(changes: DataFrame, rules: DataFrame, keep_all: bool = False) -> DataFrame:
    """Join of change records with the rule of their (table, op); a record
    without a rule is dropped, or with ``keep_all`` stays with an empty rule
    (``with_branch`` calls it ``no_rule``).  Rules are broadcast after a size
    check."""
    r = checked_broadcast(rules.select(*S.RULE_COLUMNS))
    c = with_op(changes)
    cond = (c["table"] == r["source_table"]) & (c["op"] == r["operate_type"])
    return c.join(r, cond, "left" if keep_all else "inner")


# J10 -------------------------------------------------------------------------------------
def attach_rules_asof(changes: DataFrame, history: DataFrame,
                      ts_col: str = "ts") -> DataFrame:
    """Each record meets the newest rule version already in force at its
    event time (``rule_ts <= ts``).  Versions are turned into validity bands
    on the small side, so the join is an equi-join plus a band predicate that
    matches at most one version: no aggregation over the data side."""
    iv = checked_broadcast(rule_intervals(history))
    c = with_op(changes)
    cond = ((c["table"] == iv["source_table"]) & (c["op"] == iv["operate_type"])
            & (c[ts_col] >= iv["valid_from"])
            & (iv["valid_to"].isNull() | (c[ts_col] < iv["valid_to"])))
    return c.join(iv, cond, "inner").drop("valid_from", "valid_to", "rule_ts")


# P6 / P7 ------------------------------------------------------------------------------------
def project_columns(routed: DataFrame) -> DataFrame:
    """Keep only the keys of ``data`` named in the rule's comma list (no
    trimming); a null list keeps every key.  The envelope is dropped: the
    record becomes its ``data`` plus the rule."""
    cols = fn.split_list("sink_columns")
    kept = F.when(F.col("sink_columns").isNull(), F.col("data")).otherwise(
        F.map_filter("data", lambda k, _v: F.array_contains(cols, k)))
    return routed.select(kept.alias("data"), *S.RULE_COLUMNS, *[
        c for c in ("ts", "version", "xoffset") if c in routed.columns])


# R3 ------------------------------------------------------------------------------------------
KNOWN_SINKS = (S.SINK_TYPE_KAFKA, S.SINK_TYPE_HBASE)


def with_branch(projected: DataFrame) -> DataFrame:
    """Label every record with its output: the sink type when it is a known
    one (``kafka`` main output, ``hbase`` dimension output), else
    ``dropped``; ``no_rule`` where no rule was found.  One pass; writers split
    on the label."""
    st = F.col("sink_type")
    return projected.withColumn(
        "branch", F.when(F.col("source_table").isNull(), F.lit("no_rule")).when(st.isin(*KNOWN_SINKS), st).otherwise(F.lit("dropped")))


def route(projected: DataFrame) -> dict[str, DataFrame]:
    """Split by the rule's sink type: ``kafka``, ``hbase``; anything else is
    ``dropped`` (counted, not written)."""
    labelled = with_branch(projected)
    return {b: labelled.filter(F.col("branch") == b).drop("branch")
            for b in (*KNOWN_SINKS, "dropped")}
