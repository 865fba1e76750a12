"""Topic sources: text records, one stream (or batch) per topic.

A topic is read from Kafka when a broker list is configured (``startingOffsets
latest`` when no offset is stored, read-committed isolation), otherwise from
a folder of text files per topic (``<base>/topic=<name>/``, sub-folders
``batch=<id>`` per micro-batch), which is what the tests use.  The result
always has a ``value STRING`` column.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TopicConfig:
    """Where topics live.  ``kafka_servers`` set: Kafka; else ``base_path``
    holds one folder per topic."""
    kafka_servers: str | None = None
    base_path: str | None = None
    max_files_per_trigger: int | None = None

    def path(self, topic: str) -> str:
        if not self.base_path:
            raise ValueError("base_path is needed for file topics")
        return os.path.join(self.base_path, f"topic={topic}")


def _kafka_options(cfg: TopicConfig, topic: str, group: str | None, streaming: bool) -> dict:
    # A batch read covers the topic: Spark refuses "latest" as its start.
    opts = {"kafka.bootstrap.servers": cfg.kafka_servers, "subscribe": topic,
            "startingOffsets": "latest" if streaming else "earliest", "kafka.isolation.level": "read_committed",
            "failOnDataLoss": "true"}
    if group:
        opts["kafka.group.id"] = group
    return opts


# S1 -----------------------------------------------------------------------------
def read_topic(spark: SparkSession, cfg: TopicConfig, topic: str,
               group: str | None = None, streaming: bool = True) -> DataFrame:
    """One topic as ``value STRING`` records."""
    if cfg.kafka_servers:
        reader = spark.readStream if streaming else spark.read
        return (reader.format("kafka").options(**_kafka_options(cfg, topic, group, streaming)).load()
                .select(F.col("value").cast("string").alias("value")))
    if streaming:
        reader = spark.readStream.format("text")
        if cfg.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
        return reader.load(cfg.path(topic)).select("value")
    return spark.read.format("text").load(cfg.path(topic)).select("value")


# S2 -----------------------------------------------------------------------------
def read_topics(spark: SparkSession, cfg: TopicConfig, topic: str, *topics: str,
                group: str | None = None, streaming: bool = True) -> dict[str, DataFrame]:
    """Several topics (duplicates removed) as ``{topic: DataFrame}``."""
    names = list(dict.fromkeys((topic, *topics)))
    return {t: read_topic(spark, cfg, t, group, streaming) for t in names}


# S8 -----------------------------------------------------------------------------
def from_records(spark: SparkSession, records: list[str]) -> DataFrame:
    """In-memory text records (the reference's hand-test fixtures)."""
    return spark.createDataFrame([(r,) for r in records], "value string")
