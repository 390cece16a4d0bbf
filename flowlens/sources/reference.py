"""Small reference tables: attack taxonomy and address block-lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.columns import is_ipv4, plain_name
from flowlens.functions.fixed import NORMAL, TAXONOMY
from flowlens.plans.small import small_table


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """``attack category`` lines as a table, with ``normal`` mapped to itself."""
    words = F.split(F.trim("value"), r"\s+")
    listed = (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(plain_name(words[0]).alias("attack"), words[1].alias("category"))
    )
    normal = small_table(spark, [(NORMAL, NORMAL)], listed.schema)
    # One row per name, so that a join to the table never multiplies rows.
    return listed.unionByName(normal).groupBy("attack").agg(F.max("category").alias("category"))


def default_taxonomy(spark: SparkSession) -> DataFrame:
    """The built-in taxonomy."""
    pairs = [tuple(line.split()) for line in TAXONOMY.split("\n") if line]
    return small_table(spark, pairs, "attack string, category string")


def first_word(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")[0]


def read_blocklist(spark: SparkSession, *paths: str) -> DataFrame:
    """Distinct addresses (column ``ip``) that open a line of the given feeds."""
    text = F.trim("value")
    return (
        spark.read.text(list(paths))
        .filter((text != "") & ~text.startswith("#"))
        .select(first_word(F.col("value")).alias("ip"))
        .filter(is_ipv4(F.col("ip")))
        .distinct()
    )
