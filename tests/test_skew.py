"""Hot-key behaviour: one visitor holding a third of all rows.

The skewed input is derived from the sf0.01 events by giving every third
event to visitor 0.  Results must equal the whole-key textbook forms, and
no grouping the operators shuffle on may hold the hot visitor whole.
"""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidemark.operators import logs
from tidemark.sources import projections as P
from tidemark.sources.tables import table

WITHIN = 60 * 60 * 1000


@pytest.fixture(scope="module")
def skewed(spark):
    ev = table(spark, SF01, "events")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                        .otherwise(F.col("user_id")))
    page = P.page_log(hot).cache()
    total = page.count()
    hot_rows = page.filter("common.mid = '0'").count()
    assert hot_rows * 3 >= total - 3
    return page, total, hot_rows


def test_bounce_groups_stay_small_and_exact(spark, skewed):
    page, total, hot_rows = skewed
    biggest = (page.groupBy("common.mid", F.floor(F.col("ts") / WITHIN))
               .count().agg(F.max("count")).first()[0])
    assert biggest < hot_rows / 20          # the window never holds the hot visitor whole
    w = Window.partitionBy("common.mid").orderBy("ts", "event_id")
    entry = F.coalesce(F.col("page.last_page_id"), F.lit("")) == ""
    x = (page.withColumn("_e", entry).withColumn("_nts", F.lead("ts").over(w))
         .withColumn("_ne", F.lead(entry).over(w)))
    want = x.filter(F.col("_e") & (F.col("_nts").isNull() | (F.col("_nts") - F.col("ts") >= WITHIN)
                                   | F.col("_ne"))).select("event_id")
    got = logs.bounce_visits(page, WITHIN).select("event_id")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())


def test_first_visit_flag_exact_under_skew(spark, skewed):
    page, _, _ = skewed
    got = logs.flag_new_visitors(page).filter("common.is_new = '1'").select("event_id")
    w = Window.partitionBy("common.mid").orderBy("ts", "event_id")
    want = page.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("event_id")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())


def test_daily_visitors_exact_under_skew(spark, skewed):
    page, _, _ = skewed
    got = logs.daily_unique_visitors(page).select("event_id")
    day = F.to_date(F.timestamp_millis("ts"))
    w = Window.partitionBy("common.mid", day).orderBy("ts", "event_id")
    want = page.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("event_id")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in want.collect())


def test_hot_key_aggregates_map_side(spark, skewed):
    """The arg-min aggregates run partial aggregation before their shuffle:
    the hot visitor reaches the exchange as one row per map task."""
    page, _, _ = skewed
    plan = logs.mark_earliest(page, {"_mid": F.col("common.mid")})
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        plan.explain()
    text = buf.getvalue()
    assert "partial_min(" in text and "HashAggregate" in text and "SortAggregate" not in text
