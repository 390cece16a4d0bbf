"""Number codes for categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.plans.ordering import number_rows
from flowlens.plans.skew import lookup_join
from flowlens.plans.staging import stage
from flowlens.roles import Roles

# Columns with more distinct values are coded by a join instead of a driver-side list.
MAX_LABELS = 100_000


def _vocabularies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values of every column (``_column`` its place in ``cols``, ``_word``, ``count``) without nulls.

    All from one pass over the rows, written once.
    """
    texts = [F.struct(F.lit(i).alias("_column"), F.col(c).cast("string").alias("_word")) for i, c in enumerate(cols)]
    words = df.select(F.inline(F.array(*texts))).where("_word IS NOT NULL")
    return stage(words.groupBy("_column", "_word").count(), "vocabularies")


def _small_vocabulary(df: DataFrame, cols: Sequence[str], max_labels: int) -> bool:
    """Whether every column has few enough values, from one counting pass."""
    if max_labels <= 0:
        return False
    sizes = df.agg(*(F.approx_count_distinct(c).alias(c) for c in cols)).first()
    return all(size <= max_labels for size in sizes)


def _index_by_join(df: DataFrame, col: str, out: str, keep: bool, words: DataFrame) -> DataFrame:
    """Codes from a numbered vocabulary table (``_word``, ``count``); nothing is held on the driver."""
    numbered, size = number_rows(words, [F.desc("count"), F.asc("_word")], out, total_order=True)
    codes = numbered.select("_word", (F.col(out) - 1).cast("double").alias(out))
    joined = lookup_join(df.withColumn("_word", F.col(col).cast("string")), codes, ["_word"]).drop("_word")
    if keep:
        code = F.coalesce(out, F.lit(float(size)))
    else:
        problem = F.concat(F.lit(f"no code for {col}: "), F.coalesce(col, F.lit("null")))
        code = F.coalesce(out, F.raise_error(problem).cast("double"))
    nominal = {"ml_attr": {"type": "nominal", "num_vals": size + bool(keep), "name": out}}
    columns = [c for c in joined.columns if c != out]
    return joined.select(*columns, code.alias(out, metadata=nominal))


def index_columns(
    df: DataFrame, codes: dict[str, str], keep: bool = False, max_labels: int = MAX_LABELS
) -> DataFrame:
    """Add a code column per source column: 0 for the most frequent value, ties by name."""
    if _small_vocabulary(df, list(codes), max_labels):
        indexer = StringIndexer(
            inputCols=list(codes),
            outputCols=list(codes.values()),
            handleInvalid="keep" if keep else "error",
        )
        return indexer.fit(df).transform(df)
    vocabularies = _vocabularies(df, list(codes))
    for i, (col, out) in enumerate(codes.items()):
        words = vocabularies.where(F.col("_column") == i).select("_word", "count")
        df = _index_by_join(df, col, out, keep, words)
    return df


def index_categories(
    df: DataFrame, cols: Sequence[str], keep: bool = False, max_labels: int = MAX_LABELS
) -> DataFrame:
    """Codes by falling frequency.

    By default ``x_indexed`` replaces ``x`` and a null is an error. With
    ``keep`` the source stays, ``x_index`` is added, and null gets the code
    after the last one.
    """
    if keep:
        return index_columns(df, {c: f"{c}_index" for c in cols}, True, max_labels)
    return index_columns(df, {c: f"{c}_indexed" for c in cols}, False, max_labels).drop(*cols)


def one_hot(df: DataFrame, cols: Sequence[str], max_labels: int = MAX_LABELS) -> DataFrame:
    """``x_index`` and the unit vector ``x_encoded``; null is the zero vector."""
    indexed = index_categories(df, cols, keep=True, max_labels=max_labels)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}_encoded" for c in cols]
    )
    return encoder.fit(indexed).transform(indexed)


def index_labels(df: DataFrame, roles: Roles, max_labels: int = MAX_LABELS) -> DataFrame:
    """``label_index`` and ``attack_category_index``, as far as the table has them."""
    codes = {}
    if roles.has("label"):
        codes[roles.label] = "label_index"
    if roles.has("category"):
        codes[roles.category] = "attack_category_index"
    return index_columns(df, codes, max_labels=max_labels) if codes else df
