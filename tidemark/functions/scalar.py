"""Column functions used by the jobs.  All are built-in Spark expressions, so
they stay inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference: date-time text format, age year length.
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
DATE_FMT = "yyyy-MM-dd"
MS_PER_YEAR = 1000 * 60 * 60 * 24 * 365


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F2 / P3 / F4 ---------------------------------------------------------------------
def create_date(create_time: Column | str) -> Column:
    """Characters 0..10 of the date-time text (1-based substring 1, len 10)."""
    return F.substring(_c(create_time), 1, 10)


def create_hour(create_time: Column | str) -> Column:
    """Characters 11..13 of the date-time text."""
    return F.substring(_c(create_time), 12, 2)


def create_ts(create_time: Column | str) -> Column:
    """Epoch milliseconds of the ``yyyy-MM-dd HH:mm:ss`` text.

    A cast uses Spark's built-in timestamp parser (several times faster than
    a pattern formatter) and gives the same instant for this layout; text
    that is not a date-time gives null.
    """
    return F.unix_millis(_c(create_time).try_cast("timestamp"))


# F3 ----------------------------------------------------------------------------
def ms_to_date_text(ts_ms: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(_c(ts_ms)), DATE_FMT)


def ms_to_timestamp(ts_ms: Column | str) -> Column:
    """Event-time column for watermarks (must be TIMESTAMP, not NTZ)."""
    return F.timestamp_millis(_c(ts_ms))


# F1 ----------------------------------------------------------------------------
def age_years(birthday_col: str, as_of: str) -> Column:
    """Whole 365-day years between a ``yyyy-MM-dd`` birthday column and ``as_of``;
    null where the birthday is blank or no date.

    ``as_of`` is a parameter (the reference used the wall clock) so results
    repeat.  ``div`` truncates toward zero like the reference's long arithmetic.
    """
    return F.expr(
        f"CAST((unix_millis(TIMESTAMP '{as_of}') - "
        f"unix_millis(try_to_timestamp(`{birthday_col}`, '{DATE_FMT}'))) div {MS_PER_YEAR} AS INT)")


# S9 ----------------------------------------------------------------------------
def landing_day(value: Column | str) -> Column:
    """Daily folder of a raw log line: the day of its ``ts`` (epoch ms), or of
    its arrival when the line carries no readable ``ts``."""
    ts = F.get_json_object(_c(value), "$.ts").try_cast("long")
    return F.coalesce(F.date_format(F.timestamp_millis(ts), DATE_FMT),
                      F.date_format(F.current_timestamp(), DATE_FMT))


# F8 ----------------------------------------------------------------------------
def is_blank(c: Column | str) -> Column:
    """Null or empty text."""
    return F.coalesce(_c(c), F.lit("")) == ""


def null_to_empty(c: Column | str) -> Column:
    return F.coalesce(_c(c), F.lit(""))


# F12 ---------------------------------------------------------------------------
def to_long(c: Column | str) -> Column:
    """Text -> BIGINT; text that is not a number gives null instead of failing."""
    return _c(c).try_cast("bigint")


# Page predicates -------------------------------------------------------
def is_entry_page(page: Column | str = "page") -> Column:
    """Entry page: ``last_page_id`` null or empty."""
    return is_blank(_c(page).getField("last_page_id"))


def is_non_entry_page(page: Column | str = "page") -> Column:
    """``page_id`` present and ``last_page_id`` non-empty."""
    p = _c(page)
    return p.getField("page_id").isNotNull() & (F.length(p.getField("last_page_id")) > 0)


# P12 ---------------------------------------------------------------------------
def upper_keys(m: Column | str) -> Column:
    return F.transform_keys(_c(m), lambda k, _v: F.upper(k))


# P13 ---------------------------------------------------------------------------
def with_is_new(common: Column | str, flag: Column) -> Column:
    """``common`` with its ``is_new`` field replaced by ``flag`` ("1"/"0")."""
    return _c(common).withField("is_new", flag)


# F5 / F6 -----------------------------------------------------------------------
def strip_bootstrap(op: Column | str) -> Column:
    """Change type without the ``bootstrap-`` prefix."""
    return F.regexp_replace(_c(op), "bootstrap-", "")


def split_list(c: Column | str) -> Column:
    """Comma list -> array, no trimming (the reference does not trim)."""
    return F.split(_c(c), ",")


# F11 ---------------------------------------------------------------------------
def merge_maps_right_wins(left: Column | str, right: Column | str) -> Column:
    """Map merge where keys of ``right`` replace those of ``left``.

    Implemented without depending on the session's key de-duplication policy:
    keys of ``left`` that also occur in ``right`` are filtered out first.
    """
    r = _c(right)
    l_only = F.map_filter(_c(left), lambda k, _v: ~F.array_contains(F.map_keys(r), k))
    return F.map_concat(l_only, r)


# Ordering key for arg-min / arg-max aggregates -----------------------------------
_ID_SHIFT = 2 ** 63          # maps any BIGINT id onto [0, 2^64)
_ID_SPAN = 10 ** 20          # > 2^64, so ids never carry into the time part


def order_key(ts_col: Column | str, id_col: Column | str) -> Column:
    """``(ts, id)`` packed into one ``DECIMAL(38,0)`` that sorts the same way.

    A single fixed-size, in-place-updatable value keeps ``min``/``min_by``
    on the hash-aggregate path (a struct ordering forces a sort aggregate)
    while still breaking ties on the id deterministically.  Valid for
    ``|ts| < 10^17`` — epoch milliseconds until far beyond year 3000000.
    """
    dec = "decimal(38,0)"
    span, shift = F.lit(str(_ID_SPAN)).cast(dec), F.lit(str(_ID_SHIFT)).cast(dec)
    return (_c(ts_col).cast(dec) * span + (_c(id_col).cast(dec) + shift)).cast(dec)
