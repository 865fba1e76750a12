"""Plan regression guards for the scale design (planned as at 100 TB: only
size-checked hints broadcast, no adaptive re-planning)."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from tests.conftest import SF01
from tidemark.plans.queries import QUERIES


@pytest.fixture()
def at_scale(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(spark, name, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[name](spark, SF01).explain(mode)
    return buf.getvalue()


def _hash_exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_bounce_two_hash_exchanges(at_scale):
    text = _plan(at_scale, "bounce_detail")
    ex = _hash_exchanges(text)
    assert len(ex) == 2, ex                      # window input + partial aggregate, join moves none
    assert "SortMergeJoin" in text and "SortAggregate" not in text


def test_first_visit_hash_aggregates(at_scale):
    text = _plan(at_scale, "new_visitor_flag")
    assert "SortAggregate" not in text and "partial_min(" in text
    keys = " ".join(_hash_exchanges(text))
    assert "_at" in keys                        # join back on (visitor, packed time and tie)


def test_newest_and_first_rows_use_hash_aggregates(at_scale):
    for name in ("daily_unique_visitor", "dim_upsert_latest", "dim_upsert_versions"):
        assert "SortAggregate" not in _plan(at_scale, name), name


def test_change_records_never_shuffled_on_rule_key(at_scale):
    for name in ("rule_route", "rule_asof", "project_columns"):
        text = _plan(at_scale, name)
        assert "BroadcastHashJoin" in text, name
        # the data side's key columns are exactly `table` and `op`; the rules
        # side (source_table, operate_type) may be aggregated, it is config
        data_side = [k for k in _hash_exchanges(text)
                     if re.search(r"(^|, )(table|op)#\d+", k)]
        assert not data_side, (name, data_side)


def test_scans_are_pruned(at_scale):
    text = _plan(at_scale, "order_interval_join", "formatted")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    lineitem = [s for s in schemas if "l_orderkey" in s][0]
    assert "l_returnflag" not in lineitem and "l_tax" not in lineitem


def test_order_wide_has_no_single_task_and_few_shuffles(at_scale):
    text = _plan(at_scale, "order_wide")
    assert "SinglePartition" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 10, text


def test_inputs_are_spread_only_where_they_have_fewer_partitions_than_cores(spark):
    from tidemark.sources.tables import spread
    few, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, 64)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many) is many
