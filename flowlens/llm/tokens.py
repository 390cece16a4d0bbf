"""Token counts from an exact histogram of encoded lengths.

Documents are counted by encoded length, so everything after one narrow pass works on one row per
distinct length. Suffix sums over that table answer, for every context limit, how many documents
and tokens exceed it and how many tokens remain when documents are cut there.

The sums run in two levels (blocks of ``BLOCK`` lengths, then lengths inside a block), so no task
holds all lengths.

Defined cases: null and empty texts have length 0; an empty table has no rows; repeated rows count
as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.bpe import VOCABULARY, count_tokens
from flowlens.plans.staging import stage

BLOCK = 256


def histogram(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``n_tokens`` and ``n_docs``, one row per length that occurs."""
    # Staged: the sums below read it several times.
    return stage(count_tokens(docs, path).groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")


def suffix_sums(lengths: DataFrame) -> DataFrame:
    """For each length L: documents and tokens of documents at least as long, below, and cut at L.

    ``truncated_tokens`` is the total when every document is cut to L tokens; ``rank_share`` the
    share of documents of at most L tokens.
    """
    block = F.floor(F.col("n_tokens") / BLOCK).cast("long").alias("block")
    rows = lengths.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), block)
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    # One row per block: the longest document's length over BLOCK, not the number of documents.
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("bd").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("bt").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("bd").over(everything).alias("all_docs"),
        F.sum("bt").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.col("docs_above") + F.sum("n_docs").over(inside)).alias("docs_at_least"),
        (F.col("tokens_above") + F.sum("tokens").over(inside)).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    below = F.col("all_tokens") - F.col("tokens_at_least")
    return summed.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (below + F.col("docs_at_least") * F.col("n_tokens")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")).alias("rank_share"),
        "all_docs",
        "all_tokens",
    )


def truncated_total(sums: DataFrame, limit: int) -> Column | DataFrame:
    """One row: ``truncated_tokens`` when documents are cut to any ``limit``, occurring or not."""
    # Documents above the limit start at the smallest occurring length above it.
    longer = sums.where(F.col("n_tokens") > limit).agg(
        F.max("docs_at_least").alias("d"), F.max("tokens_at_least").alias("t")
    )
    total = sums.agg(F.max("all_tokens").alias("all"))
    # Both sides are single aggregate rows.
    return longer.withColumn("k", F.lit(0)).join(total.withColumn("k", F.lit(0)), "k").select(
        F.lit(limit).cast("long").alias("context_limit"),
        (
            F.coalesce("all", F.lit(0)) - F.coalesce("t", F.lit(0)) + limit * F.coalesce("d", F.lit(0))
        ).alias("truncated_tokens"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share`` and the smallest length that at least this share of the documents do not exceed."""
    picked = [F.min(F.when(F.col("rank_share") >= s, F.col("n_tokens"))).alias(f"q{i}") for i, s in enumerate(shares)]
    pairs = F.array(
        *[F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, s in enumerate(shares)]
    )
    return sums.agg(*picked).select(F.inline(pairs))
