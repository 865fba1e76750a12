"""Ranks over a whole column without one task that sees all of it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_path

_PLACE_BITS = 33        # of ``monotonically_increasing_id``: partition above, row below


def dense_ranks(values: DataFrame, column: str, rank: str = "rank") -> DataFrame:
    """``(column, rank)``: each different value that is not null with its dense rank, from 1.

    The different values are range-partitioned and sorted inside their partitions;
    what the partitions before one hold (one number per partition) is added to the
    row's place in it.  The sorted values are written once to the shared folder, so
    that places and counts are of the same partitions."""
    spark = values.sparkSession
    path = shared_path(spark, "ranks", uuid.uuid4().hex)
    place = F.monotonically_increasing_id()
    (values.select(column).where(F.col(column).isNotNull()).distinct()
     .repartitionByRange(column).sortWithinPartitions(column)
     .select(column, F.shiftright(place, _PLACE_BITS).alias("_part"),
             place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place")).write.parquet(path))
    placed = spark.read.schema(values.select(column, F.lit(0).cast("long").alias("_part"),
                                             F.lit(0).cast("long").alias("_place")).schema).parquet(path)
    before, offsets = 0, []
    for r in sorted(placed.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        offsets.append((r._part, before))
        before += r.n
    per_part = spark.createDataFrame(offsets, "_part long, _before long")
    return placed.join(F.broadcast(per_part), "_part").select(
        column, (F.col("_before") + F.col("_place") + 1).alias(rank))
