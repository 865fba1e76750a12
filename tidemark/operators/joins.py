"""Join helpers with explicit size checks.

Only sides whose size is *checked* get a broadcast hint.  Sides derived from
the data (aggregates, dimension tables) carry no hint: adaptive execution
measures their shuffle output at run time and converts the join to a
broadcast only when it is actually small, with the sort-merge join (and its
skew splitting) as the fall-back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a configuration table may hold and still be broadcast.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 << 20


class SideTooLarge(ValueError):
    pass


def _measure(df: DataFrame) -> tuple[int, int]:
    """Rows of a frame and their size as text."""
    return tuple(df.agg(F.count("*"), F.coalesce(
        F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0))).first())


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                       max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` where its measured size allows, else ``df`` for a shuffle.

    For small dimensions that a larger one refers to: with few rows a shuffle on
    their keys would put the larger side into a few tasks; with many rows the
    keys are many, and the shuffle spreads."""
    n, size = _measure(df)
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` after checking its rows and its size as text; a larger
    side is refused.

    Meant for configuration (routing rules, their history): joined on a handful
    of keys, it has no other good plan, since shuffling the data on those keys
    would put it into a few tasks.  Measuring it is cheap and done once per job."""
    n, size = _measure(df)
    if n > max_rows or size > max_bytes:
        raise SideTooLarge(f"{n} rows of {size} characters; at most {max_rows} and {max_bytes}")
    return F.broadcast(df)
