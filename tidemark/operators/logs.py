"""App-log detail layer: parse, first-visit flag, three-way split.

Everything here is a plain DataFrame transformation; the same functions run
on batch tables and (where noted) inside ``foreachBatch`` of a stream.

Scale notes
-----------
* The first visit is a per-visitor minimum of a packed (ts, tie) key (hash
  aggregate with map-side partial aggregation, so a visitor holding a third of
  all rows is collapsed before the shuffle), joined back on (visitor, key).
  No task ever sorts all rows of one hot visitor.
* Records are open: a ``record`` column carries the raw text through every
  operator, so fields that no schema declares reach the outputs.
* The split is three filters over one input (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions import json_text as jt
from tidemark.functions import scalar as fn

CORRUPT = "_corrupt_record"


# P1 --------------------------------------------------------------------------
def parse_json(text: DataFrame, schema: T.StructType, value_col: str = "value",
               keep_corrupt: bool = True) -> DataFrame:
    """JSON text -> typed columns with an explicit schema (PERMISSIVE).

    With ``keep_corrupt`` text that is not a JSON object keeps its raw value
    in ``_corrupt_record`` (all other fields null) so it can be sent to a
    quarantine output instead of failing the job.  Without it the cheaper
    plain parse is used and records with no field at all are dropped.
    """
    if keep_corrupt:
        sch = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        parsed = text.select(F.from_json(
            F.col(value_col), sch,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
        return parsed.select("r.*")
    return parse_where(text, F.from_json(F.col(value_col), schema),
                       lambda r: any_field(r, schema.fieldNames()))


def any_field(r: Column, names: list[str]) -> Column:
    """Whether any field of a parsed record holds a value."""
    cond = F.lit(False)
    for f in names:
        cond = cond | r[f].isNotNull()
    return cond


def parse_where(text: DataFrame, parsed: Column, keep) -> DataFrame:
    """Rows of ``parsed`` (a struct expression over ``text``) for which
    ``keep(struct)`` holds, expanded to columns.

    The parse sits in a one-element generator: a plain ``filter`` over the
    parsed fields would be pushed below any exchange to the scan and would
    re-run the parser once per referenced field; here it runs once per row,
    wherever the plan places it.
    """
    return text.select(F.inline(F.filter(F.array(parsed), keep)))


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, quarantined raw text)."""
    good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
    return good, bad


def unparsable(text: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Raw lines that give no field under ``schema`` (malformed text or an
    empty object), for a quarantine output; the cheap parse, run once."""
    rec = F.struct(F.col(value_col).alias("value"),
                   F.from_json(F.col(value_col), schema).alias("r"))
    return (text.select(F.inline(F.filter(F.array(rec),
                                          lambda x: ~any_field(x["r"], schema.fieldNames()))))
            .select("value"))


RECORD = "record"       # the raw text of a record, carried along with its parsed fields


def _with_record(text: DataFrame, schema: T.StructType, value_col: str) -> DataFrame:
    rec = F.struct(F.col(value_col).alias(RECORD), F.from_json(value_col, schema).alias("r"))
    keep = lambda x: any_field(x["r"], schema.fieldNames())
    return text.select(F.inline(F.filter(F.array(rec), keep))).select("r.*", RECORD)


def parse_app_log(text: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw ``ods_log`` text -> app-log records, each with its raw text as
    ``record``; malformed text dropped (``unparsable`` keeps it)."""
    return _with_record(text, S.APP_LOG, value_col)


def parse_visits(text: DataFrame, value_col: str = "value") -> DataFrame:
    """The same records with only the fields a first visit is decided by."""
    return _with_record(text, S.VISIT, value_col)


# Open records (P1, P13, R2, F11) ---------------------------------------------------
def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def whole_record(record: Column | str, is_new: Column | None = None) -> Column:
    """The record's JSON text, byte for byte as it came; with ``is_new`` (``0`` / ``1``
    text) only the value of ``common.is_new`` is another.  A record without
    ``common``, or with null ``is_new``, stays as it is."""
    r = F.col(record) if isinstance(record, str) else record
    if is_new is None:
        return r
    return F.when(is_new.isNull(), r).otherwise(
        jt.with_member(r, ("common", "is_new"), _quoted(is_new)))


def display_records(log: DataFrame) -> DataFrame:
    """R2 on open records: one JSON text per display element, with all members of
    the element, ``ts``, ``page_id`` and all members of ``common`` (the rewritten
    ``is_new`` included), each as it was written; later ones replace earlier ones
    of the same name.  An element that is no object adds nothing of its own."""
    # Spark's parser writes a value asked for as text in one way of many; where that is
    # how the record has it, the value need not be searched for.
    record = F.col("_record")
    read = _bound(log, {
        "_raw": F.from_json(RECORD, "common string, displays array<string>, ts string"),
        "_record": F.col(RECORD), "_flag": F.coalesce("common.is_new", F.lit("0")),
        "_page_id": F.col("page.page_id"), "_typed": F.col("displays")})
    own = F.coalesce(_written("common", F.col("_raw.common"), record), jt.member(record, "common"))
    list_text = F.concat(F.lit("["), F.array_join("_raw.displays", ","), F.lit("]"))
    elements = F.when(_written("displays", list_text, record).isNotNull(), F.col("_raw.displays")).otherwise(
        jt.elements(jt.member(record, "displays")))
    found = _bound(read, {
        "_own": own, "_flag": F.col("_flag"),
        "_ts": F.coalesce(_written("ts", F.col("_raw.ts"), record), jt.member(record, "ts")),
        "_page": F.coalesce(_written("page_id", _quoted(F.col("_page_id")), record),
                            jt.member(jt.member(record, "page"), "page_id")),
        "_elements": F.arrays_zip(elements.alias("text"), F.col("_typed").alias("typed"))})
    common = _bound(found, {
        "_common": jt.with_member(F.when(F.col("_own").startswith("{"), F.col("_own")).otherwise("{}"),
                                  ("is_new",), _quoted(F.col("_flag"))),
        "_ts": F.concat(F.lit('"ts":'), "_ts"), "_page": F.concat(F.lit('"page_id":'), "_page"),
        "_elements": F.col("_elements")})
    keys = F.json_object_keys("_common")
    before = [F.when(~F.array_contains(keys, name), F.col(c))
              for c, name in (("_ts", "ts"), ("_page", "page_id"))]
    names = [F.when(b.isNotNull(), F.lit(name)) for b, name in zip(before, ("ts", "page_id"))]
    # What every element of a record gets is made once per record.
    shared = _bound(common, {
        "_shared": F.concat_ws(",", *before, _inside(F.col("_common"))),
        "_taken": F.concat(keys, F.array_compact(F.array(*names))), "_elements": F.col("_elements")})
    each = _bound(shared.select(F.explode("_elements").alias("_e"), "_shared", "_taken"), {
        "_d": F.when(F.col("_e.typed").isNotNull(), F.col("_e.text")).otherwise("{}"),
        "_shared": F.col("_shared"), "_taken": F.col("_taken")})
    left = F.array_join(F.filter(jt.members(F.col("_d")), lambda m: ~F.array_contains(
        F.col("_taken"), jt.key_of(m))), ",")
    clash = F.arrays_overlap(F.json_object_keys("_d"), "_taken")
    mine = jt.let(F.when(clash, left).otherwise(_inside(F.col("_d"))),
                  lambda m: F.when(F.trim(m) != "", m))
    return each.select(F.concat(F.lit("{"), F.concat_ws(",", mine, "_shared"), F.lit("}")).alias("value"))


def _inside(text: Column) -> Column:
    """The members of an object's text, as one text."""
    return F.substr(text, F.lit(2), F.length(text) - 2)


def _written(name: str, value: Column, text: Column) -> Column:
    """``value`` where ``text`` has just that behind its only ``name``; else null."""
    there = text.contains(F.concat(F.lit(f'"{name}":'), value)) & jt.once(text, name)
    return F.when(there & ~text.contains("\\"), value)


def _bound(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df.select`` of the columns behind a one-element generator: they are computed once
    per row, and not again wherever later columns refer to them."""
    return df.select(F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


# A1 / A2 / A3 / P13 --------------------------------------------------------------
def tie_of(df: DataFrame, id_col: str = "event_id") -> Column:
    """What decides between records of the same instant: the record id or,
    without one, a hash of the record."""
    rest = [RECORD] if RECORD in df.columns else df.columns
    by_content = F.xxhash64(*rest)
    return F.coalesce(F.col(id_col), by_content) if id_col in df.columns else by_content


def mark_earliest(df: DataFrame, keys: dict[str, Column], id_col: str = "event_id",
                  ts_col: str = "ts", narrow: DataFrame | None = None) -> DataFrame:
    """``df`` with ``_first``: true on exactly one row per combination of the
    (non-null) keys, the earliest, ties decided by ``tie_of``; of rows equal in
    that too any one.

    A minimum of a packed fixed-size key per combination, joined back on
    (keys, packed key).  Equal rows are counted through, in no order, where the
    join put them together: no further shuffle, sort or hash of whole rows.  The
    minimum may be taken over ``narrow``: the same records with fewer fields,
    cheaper to parse."""
    def keyed(frame: DataFrame) -> DataFrame:
        return frame.withColumns({**keys, "_at": fn.order_key(
            F.col(ts_col), tie_of(frame, id_col))})

    own = keyed(df)
    names = list(keys)
    low = keyed(df if narrow is None else narrow).groupBy(*names).agg(
        F.min("_at").alias("_at")).withColumn("_low", F.lit(True))
    joined = own.join(low, [*names, "_at"], "left")
    same = Window.partitionBy(*names, "_at").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("_low").isNotNull() & (F.count(F.lit(1)).over(same) == 1)
    return joined.withColumn("_first", first).select(*df.columns, *names, "_first")


def flag_new_visitors(log: DataFrame, mid: Column | None = None,
                      id_col: str = "event_id", ts_col: str = "ts",
                      narrow: DataFrame | None = None) -> DataFrame:
    """Rewrite ``common.is_new``: ``1`` on the first record ever seen of a
    visitor (earliest ``ts``, see ``tie_of``), ``0`` on all others; of a record
    that came twice only one is the first.  Records without a visitor are never
    new.  Every record is kept (the reference's literal code lost later windows
    of a known visitor; its stated rule keeps them).  ``narrow``: the same
    records from ``parse_visits``, for records with their text.
    """
    mid = mid if mid is not None else F.col("common.mid")
    marked = mark_earliest(log, {"_mid": mid}, id_col, ts_col, narrow)
    flag = F.when(F.col("_first"), F.lit("1")).otherwise(F.lit("0"))
    return marked.withColumn("common", fn.with_is_new("common", flag)).select(*log.columns)


# R1 / R2 -------------------------------------------------------------------------
def split_logs(log: DataFrame) -> dict[str, DataFrame]:
    """Three outputs of one input: ``start`` (start logs only), ``page`` (no
    start, page present; keeps its ``displays`` whole) and ``displays`` (no
    start, one record per display element).  A record can be page *and*
    displays."""
    no_start = F.col("start").isNull()
    return {
        "start": log.filter(F.col("start").isNotNull()),
        "page": log.filter(no_start & F.col("page").isNotNull()),
        "displays": explode_displays(log.filter(no_start & F.col("displays").isNotNull())),
    }


def explode_displays(log: DataFrame) -> DataFrame:
    """One record per display element, enriched with the record's ``ts``, the
    page's ``page_id`` (null when the record has no page) and every field of
    ``common``.  On a name clash ``common`` wins over ``page_id``, which wins
    over ``ts``, which wins over the element's own field."""
    disp_fields = log.schema["displays"].dataType.elementType.fieldNames()
    common_fields = log.schema["common"].dataType.fieldNames()
    e = log.select(F.explode("displays").alias("_d"), "ts",
                   F.col("page.page_id").alias("page_id"), "common")
    taken: set[str] = set()
    cols: list[Column] = []
    for name in common_fields:
        cols.append(F.col(f"common.{name}").alias(name))
        taken.add(name)
    for name, c in (("page_id", F.col("page_id")), ("ts", F.col("ts"))):
        if name not in taken:
            cols.append(c.alias(name))
            taken.add(name)
    disp_cols = [F.col("_d").getField(n).alias(n) for n in disp_fields if n not in taken]
    return e.select(*disp_cols, *cols)


# A4 ------------------------------------------------------------------------------
def daily_unique_visitors(page_log: DataFrame, id_col: str = "event_id",
                          ts_col: str = "ts") -> DataFrame:
    """The earliest page record of every visitor per calendar day (UTC) of the
    record itself, as (mid, visit_date, the record's columns).  Records without
    a visitor count for none."""
    marked = mark_earliest(page_log, {"mid": F.col("common.mid"),
                                      "visit_date": fn.ms_to_date_text(ts_col)}, id_col, ts_col)
    return marked.where("_first").select("mid", "visit_date", *page_log.columns)


# W4 / W5 / U1 (batch form) ----------------------------------------------------------
def pattern_predicates(next_rule: str = "entry", start_when: Column | str | None = None,
                       next_when: Column | str | None = None) -> tuple[Column, Column]:
    """The two steps of the pattern as boolean expressions (SQL text or
    Columns).  Defaults: start = entry page; next = entry page
    (``next_rule="entry"``) or non-entry page (``"non_entry"``)."""
    def as_col(x):
        return F.expr(x) if isinstance(x, str) else x
    start = as_col(start_when) if start_when is not None else fn.is_entry_page("page")
    if next_when is not None:
        nxt = as_col(next_when)
    elif next_rule == "entry":
        nxt = fn.is_entry_page("page")
    elif next_rule == "non_entry":
        nxt = fn.is_non_entry_page("page")
    else:
        raise ValueError("next_rule in {entry, non_entry}")
    return F.coalesce(start, F.lit(False)), F.coalesce(nxt, F.lit(False))


def bounce_visits(page_log: DataFrame, within_ms: int, next_rule: str = "entry",
                  emit: str = "both", id_col: str = "event_id",
                  ts_col: str = "ts", start_when: Column | str | None = None,
                  next_when: Column | str | None = None) -> DataFrame:
    """Entry pages that were not followed in time: the two-step pattern
    ``start`` = entry page, strictly next event (same visitor, event-time
    order) within ``within_ms``.

    * ``next_rule="entry"``, ``emit="both"`` (the main job): a match (next is
      an entry page inside the band) and a timeout (no next event inside the
      band) both emit the start record; U1 is the OR of the two.
    * ``next_rule="non_entry"``, ``emit="timeout"`` (the variant): matches
      are discarded, only timeouts are emitted.
    * ``start_when`` / ``next_when`` (SQL text or Columns) replace the two
      step predicates (X3).

    A gap of exactly ``within_ms`` is a timeout.

    Plan: rows are bucketed by ``floor(ts / within_ms)``; the next event is
    found by ``lead`` inside (visitor, bucket); for the last row of a bucket
    it is the first row of the following bucket (an arg-min aggregate joined
    on (visitor, bucket - 1)).  A next event further away is beyond the band
    and needs no look-up, so the result is exact and no window ever holds more
    than one band of one visitor's events (all of a robot's events inside one
    band are one window task).
    """
    if emit not in ("both", "timeout"):
        raise ValueError("emit in {both, timeout}")
    start, follows = pattern_predicates(next_rule, start_when, next_when)
    base = (page_log
            .withColumn("_tie", tie_of(page_log, id_col))
            .withColumn("_mid", F.col("common.mid"))
            .withColumn("_b", F.floor(F.col(ts_col) / F.lit(within_ms)).cast("long"))
            .withColumn("_entry", start)
            .withColumn("_ok", follows))
    nxt = F.struct(F.col(ts_col).alias("ts"), F.col("_ok").alias("ok"))
    w = Window.partitionBy("_mid", "_b").orderBy(ts_col, "_tie")
    starts = (base.withColumn("_next", F.lead(nxt).over(w))
              .filter(F.col("_entry")))
    # first row of every bucket, keyed by the bucket *before* it: grouping by
    # (mid, b - 1) leaves the aggregate hash-partitioned exactly like the
    # window output, so the join below moves neither side again
    key = fn.order_key(ts_col, "_tie")
    firsts = (base.groupBy("_mid", (F.col("_b") - 1).alias("_b"))
              .agg(F.min_by(F.col(ts_col), key).alias("_fts"),
                   F.min_by(F.col("_ok"), key).alias("_fok"))
              .select("_mid", "_b",
                      F.struct(F.col("_fts").alias("ts"), F.col("_fok").alias("ok")).alias("_nb")))
    j = starts.join(firsts, ["_mid", "_b"], "left")
    next_ts = F.coalesce(F.col("_next.ts"), F.col("_nb.ts"))
    next_ok = F.coalesce(F.col("_next.ok"), F.col("_nb.ok"))
    timeout = next_ts.isNull() | ((next_ts - F.col(ts_col)) >= F.lit(within_ms))
    # match: the strictly next event is inside the band and meets the rule
    keep = timeout if emit == "timeout" else (timeout | next_ok)
    return j.filter(keep).select(*page_log.columns)
