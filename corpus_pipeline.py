"""The corpus pipeline: quality rules, quality classifier, near-duplicates,
repeated passages, packing.  Each stage is written as Parquet in the shared
folder and reread as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chunks, line_rules, packing, quality, simhash
from tidemark.llm.common import documents, prepare, staged
from tidemark.llm.vocabulary import broadcast_vocabulary
from tidemark.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; of the others, the failing lines."""
    prepare(spark)
    return line_rules.clean(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold go.  The rules before have
    taken out most bad examples, so the fit reads the labelled rows of the
    uncleaned documents; where nothing can be learned, nothing goes."""
    prepare(spark)
    model = quality.fit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    if model is None:
        return docs
    own = [F.col(f"`{c}`") for c in docs.columns]
    scored = docs.select(F.struct(*own).alias("doc"), quality.score("text", model).alias("score"))
    return scored.where(F.col("score") >= quality.THRESHOLD).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays (the smallest id)."""
    prepare(spark)
    return simhash.keep_one_per_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are taken out of the texts."""
    prepare(spark)
    return chunks.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces of token windows."""
    prepare(spark)
    return packing.pack(docs, broadcast_vocabulary(spark))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: Tokens, chunk boundaries and the fitted classifier are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
