"""Readers for the parquet tables the warehouse is fed from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder.  Parquet: column pruning and
    predicate pushdown reach the scan through Catalyst; the scan decides the
    partitions."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` for work that is heavy per row: over all cores, where its input has fewer
    partitions than the cluster has cores (few row groups make few scan tasks, however
    many cores there are).  An input with enough partitions stays as it is, so a large
    table is never shuffled for this."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
