"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import let_workers_import, shared_path
from tidemark.sources.tables import table

HELD_OUT_REMAINDER = 2      # crc32(doc_id as text) mod 4 of the rows no model learns from


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def held_out(doc_id: Column) -> Column:
    """True for the rows kept away from every fit; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4
            == HELD_OUT_REMAINDER)


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage, so a lost executor costs a re-read and not a re-run of
    the steps before, and lets several consumers share one computation."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unaligned(key: Column) -> Column:
    """The same long key, but opaque to the planner's partitioning.

    An aggregate joined back on its own key needs no exchange, and then
    adaptive execution cannot split a hot key of the other side.  With the
    key hidden both sides are exchanged and the split applies."""
    return key.bitwiseXOR(F.lit(0).cast("long"))


def prepare(spark: SparkSession) -> None:
    """Settings of the operators that run Python: bound what one Arrow batch of
    whole texts takes in a worker, and let workers that share this machine's
    folders import the package wherever the job was started from."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    let_workers_import(spark)
