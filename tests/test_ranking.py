from __future__ import annotations

import random

from tidemark.operators.ranking import dense_ranks


def test_dense_ranks_equal_a_sort(spark):
    r = random.Random(2)
    values = [r.choice([None, *(f"v{r.randrange(500)}" for _ in range(3)), "hot", "é", ""])
              for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    got = {x.v: x.k for x in dense_ranks(df, "v", "k").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted({v for v in values if v is not None}))}
    assert dense_ranks(df.where("false"), "v").collect() == []


def test_no_single_task(spark):
    plan = dense_ranks(spark.range(100).selectExpr("id % 10 as v"), "v")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
