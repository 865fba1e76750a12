"""Topic sinks: records as JSON text, to Kafka or to one folder per topic.

File layout (also read by ``tidemark.sources.topics``):
``<base>/topic=<name>/batch=<id>/``.  The output of a micro-batch, all its topics
together, is committed by one manifest:

1. the files are written below ``_staging/<job>/batch=<id>/``, where no reader looks;
2. the manifest ``_commits/<job>/batch=<id>.json`` names them with their sizes.  It
   appears whole, and from then on the batch is never computed again;
3. each file it names is moved to its topic, unless it is there in full.

A replay goes on where the batch stopped: before the manifest it starts anew (the
staged files are overwritten), after it only missing or incomplete files are moved.
So every file reaches its topic once under one name, whatever two writes a crash
falls between, and a file stream reads every record once.  Kafka output is at
least once.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import logs
from tidemark.sinks import fs
from tidemark.sources.topics import TopicConfig


def as_value(df: DataFrame) -> DataFrame:
    """The whole record as JSON text.  A frame that already is ``value``
    text is kept; one that carries the raw ``record`` gives that text, with the
    ``is_new`` of its ``common`` column."""
    if df.columns == ["value"] and df.schema["value"].dataType.simpleString() == "string":
        return df
    if logs.RECORD in df.columns:
        is_new = F.col("common.is_new") if "common" in df.columns else None
        return df.select(logs.whole_record(logs.RECORD, is_new).alias("value"))
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


# W7 -----------------------------------------------------------------------------
KEPT_COMMITS = 20       # Spark replays the newest batch only


def _commit(spark, cfg: TopicConfig, job: str, batch_id: int) -> tuple[str, str]:
    return (f"{cfg.base_path}/_staging/{job}/batch={batch_id}",
            f"{cfg.base_path}/_commits/{job}/batch={batch_id}.json")


def write_batch(records: DataFrame, cfg: TopicConfig, job: str, batch_id: int) -> None:
    """The output ``(topic, value)`` of one micro-batch of ``job``, to all its topics
    (see the module).  One write, no shuffle by topic: every task writes its own
    file for each topic it holds."""
    if cfg.kafka_servers:
        (records.write.format("kafka").option("kafka.bootstrap.servers", cfg.kafka_servers).save())
        return
    spark, batch_id = records.sparkSession, int(batch_id)
    staging, manifest = _commit(spark, cfg, job, batch_id)
    if not fs.exists(spark, manifest):
        records.write.mode("overwrite").partitionBy("topic").text(staging)
        fs.write_text(spark, manifest, json.dumps(fs.list_files(spark, staging)))
    publish(spark, cfg, job, batch_id)


def publish(spark, cfg: TopicConfig, job: str, batch_id: int) -> None:
    """Move what a committed batch's manifest names to its topics, as far as it is
    not there; a file that is neither here nor there ends the job."""
    staging, manifest = _commit(spark, cfg, job, batch_id)
    for name, size in json.loads(fs.read_text(spark, manifest)):
        topic, file = name.rsplit("/", 1)
        target = f"{cfg.base_path}/{topic}/batch={batch_id}/{file}"
        if fs.file_size(spark, target) == size:
            continue
        if fs.file_size(spark, f"{staging}/{name}") != size:
            raise OSError(f"batch {batch_id} of {job}: {name} is lost")
        fs.move_file(spark, f"{staging}/{name}", target)
    fs.remove(spark, staging)
    old = _commit(spark, cfg, job, batch_id - KEPT_COMMITS)[1]
    if fs.exists(spark, old):
        fs.remove(spark, old)


def to_topic(df: DataFrame, topic: str) -> DataFrame:
    """Records as ``(topic, value)`` for ``write_batch``."""
    return as_value(df).select(F.lit(topic).alias("topic"), "value")


def addressed(df: DataFrame, topic_col: str) -> DataFrame:
    """``(topic, value)`` of records that name their topic in ``topic_col``."""
    payload = [c for c in df.columns if c != topic_col]
    single = len(payload) == 1 and df.schema[payload[0]].dataType.typeName() in ("map", "struct")
    value = F.to_json(F.col(payload[0]) if single else F.struct(*payload))
    return df.select(F.col(topic_col).alias("topic"), value.alias("value"))


# S3 -----------------------------------------------------------------------------
def write_topic(df: DataFrame, cfg: TopicConfig, topic: str, batch_id: int | None = None) -> None:
    """Batch write of records to one topic.  File form: with a ``batch_id`` the write
    is committed as a batch of the job ``to-<topic>``, idempotent on replay."""
    if cfg.kafka_servers or batch_id is not None:
        write_batch(to_topic(df, topic), cfg, f"to-{topic}", batch_id or 0)
    else:
        as_value(df).write.mode("append").text(cfg.path(topic))


def topic_stream_writer(df: DataFrame, cfg: TopicConfig, topic: str, checkpoint: str):
    """Streaming sink of one topic (file sink: exactly once with checkpoint;
    Kafka: at least once, readers de-duplicate)."""
    out = as_value(df)
    if cfg.kafka_servers:
        return (out.writeStream.format("kafka")
                .option("kafka.bootstrap.servers", cfg.kafka_servers)
                .option("topic", topic).option("checkpointLocation", checkpoint))
    return (out.writeStream.format("text").option("path", cfg.path(topic))
            .option("checkpointLocation", checkpoint))


# S4 -----------------------------------------------------------------------------
def write_addressed(df: DataFrame, cfg: TopicConfig, topic_col: str,
                    batch_id: int | None = None) -> None:
    """Each record goes to the topic named in its ``topic_col``: with Kafka the
    record's topic, as files one partitioned write."""
    out = addressed(df, topic_col)
    if cfg.kafka_servers or batch_id is not None:
        write_batch(out, cfg, f"by-{topic_col}", batch_id or 0)
    else:
        out.write.mode("append").partitionBy("topic").text(cfg.base_path)
