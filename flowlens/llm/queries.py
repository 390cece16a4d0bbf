"""Registered queries of the text operators: digests of their real outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import bpe, chat, decontam, jaccard, langid, licenses, lines, quality, resampling, simhash, spelling
from flowlens.llm import tokens, toxicity
from flowlens.llm.oracles import ORACLES  # noqa: F401
from flowlens.llm.text import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), jaccard.Space(words=3, near=90))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.suffix_sums(tokens.histogram(table(spark, sf_dir, "documents")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.apply_rules(table(spark, sf_dir, "documents"))
    return rated.drop("broken_rules")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_hostile_conversation(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_conversations(rows)).drop("rewrites")


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.learn_and_scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_lines",
        F.size("findings").cast("long").alias("n_findings"),
        F.array_join(F.array_sort(F.array_distinct(F.col("findings.family"))), ",").alias("families"),
        F.coalesce(F.array_min(F.col("findings.probability")), F.lit(0.0)).alias("least_probability"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, near=3)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_bpe": op7_bpe,
    "op8_language_id": op8_language_id,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_license_scans": op10_license_scans,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_simhash": op13_simhash,
}
