"""Every registered query against its DuckDB SQL (the driver's gate)."""

from __future__ import annotations

import pytest

from tests.oracle_check import compare
from tests.conftest import SF01

import __spark_entry__ as E
from tidemark.plans.queries import QUERIES
from tidemark.plans.stream_queries import STREAM_QUERIES


def test_every_warehouse_query_has_sql():
    assert {*QUERIES, *STREAM_QUERIES} <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF01, [name], verbose=False)[name]
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[:3] == ["detail_id", "order_id", "sku_id"]
