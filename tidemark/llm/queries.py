"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (ann, bpe, chunks, language, line_rules, merkle, packing, pii,
                          quality, runs, simhash, url_templates, warc)
from tidemark.llm.common import documents, held_out, prepare, run_folder
from tidemark.llm.vocabulary import broadcast_vocabulary
from tidemark.sources.tables import table


URL_RULES = ["allow org/", "block example.org/es/", "block example.org/en/1",
             "allow com/fr/", "block com/de/"]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         quality.score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages"),
                               url_templates.parse_rules(URL_RULES))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vocabulary = broadcast_vocabulary(spark)
    coded = documents(spark, sf_dir).select("doc_id", bpe.encode("text", vocabulary).alias("ids"))
    both = coded.select("doc_id", "ids", bpe.decode("ids", vocabulary).alias("decoded"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.fields(warc.read_archive(spark, folder))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        language.predict("text", language.fit(docs)).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    done = chunks.deduplicate(documents(spark, sf_dir))
    return done.select("doc.doc_id", "text", "spans", "owners")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = simhash.near_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pieces = packing.pack(documents(spark, sf_dir), broadcast_vocabulary(spark))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_rules.judge(documents(spark, sf_dir)).select(
        "doc.doc_id", *[f"rules.{c}" for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "lost_chars", "base_failed", "kept")])


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    text = runs.with_repeated_tail(F.col("text"), F.col("doc_id"))
    found = documents(spark, sf_dir).select("doc_id", runs.periodic_runs(text).alias("r"))
    lines = F.transform("r.runs", lambda x: F.concat(
        x["start"], F.lit(","), x["length"], F.lit(","), x["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size("r.runs").cast("long").alias("n_runs"),
        *[F.col(f"r.best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * r.best.length div r.best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("r.collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(documents(spark, sf_dir))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir)).select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS],
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_url_filters": op2_url_filters,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_warc_archive": op4_warc_archive,
    "op8_packing": op8_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op5_language_id": op5_language_id,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_personal_data": op13_personal_data,
}
