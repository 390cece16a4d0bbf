"""Cleaning of a document corpus in named stages, each written and read again.

toxicity: rejected documents go. line_dedup: lines of earlier documents go, every document stays.
near_duplicates: of each group linked by five-word shingles at a similarity of 0.8, one row stays: that
with the smallest id (a null id is below all others), of several texts with this id the one with the
smallest hash, of rows that repeat both the one whose other columns are smallest. Texts without words are
in no group and all stay; a text that only shares its id with a copy stays. decontamination: documents contaminated by the benchmark go. bpe: the others
are encoded. All but the last return the columns of documents; a null text counts as empty where it
is rewritten.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import bpe, decontam, jaccard, lines, toxicity
from flowlens.llm.chunks import unused
from flowlens.plans.staging import stage

#: Most removed ids that are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned from the labelled documents of the corpus, applied to ``docs``."""
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = unused(docs, "toxicity")
    scored = toxicity.score(docs, toxicity.fit(corpus, labels), name)
    return scored.where(F.col(name) < 0.5).select(docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    kept = lines.dedup_lines(docs, carry=others)
    return kept.withColumn("text", F.col("kept_text")).select(docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.grouped(docs, jaccard.Space(words=5, near=80))
    id_name, hash_name, kind = (unused(docs, c) for c in ("near_id", "near_hash", "near_kind"))
    rows = found.groupBy(F.col("doc_id").alias(id_name), F.col("h").alias(hash_name)).agg(
        F.count("*").alias("n"), F.min("first").alias("first"), F.min("n_shingles").alias("size")
    )
    # Rows that go, and rows of which one stays; all others are as they were.
    marked = F.when(~F.col("first"), "goes").when((F.col("n") > 1) & (F.col("size") > 0), "repeated")
    others = stage(rows.select(id_name, hash_name, marked.alias(kind)).where(F.col(kind).isNotNull()), "others")
    if others.count() <= BROADCAST_IDS:
        others = F.broadcast(others)
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(id_name))
    same &= F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(hash_name)
    joined = docs.join(others, same, "left")
    single = joined.where(F.col(kind).isNull()).select(docs.columns)
    whole = F.min(F.struct(*docs.columns)).alias("row")
    repeated = joined.where(F.col(kind) == "repeated").groupBy(id_name, hash_name).agg(whole)
    return single.unionByName(repeated.select("row.*"))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("bpe", encode),
]

#: The stages with a model and with tokens have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
