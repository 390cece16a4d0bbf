"""Most frequent values without shuffling every distinct one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.plans.small import small_table
from flowlens.plans.staging import stage

#: Buckets per column; so many counts per column and task cross the first shuffle at most.
BUCKETS = 1 << 16
#: Buckets looked into at first, for each value wanted, and how many times more in each further round.
FIRST, MORE = 8, 16
COLUMN, VALUE, BUCKET = "column", "value", "_bucket"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), F.col(VALUE)), F.lit(buckets)).cast("int")


def _ranked(counted: DataFrame) -> DataFrame:
    best = Window.partitionBy(COLUMN).orderBy(F.desc("count"), F.asc(VALUE))
    return counted.withColumn("rank", F.row_number().over(best))


def counted_values(values: DataFrame, k: int) -> DataFrame:
    """As ``heavy_values``, in one lazy pass that shuffles every distinct value: for columns with few of them."""
    return _ranked(values.groupBy(COLUMN, VALUE).count()).where(F.col("rank") <= k)


def heavy_values(values: DataFrame, k: int, buckets: int = BUCKETS, first: int = FIRST) -> DataFrame:
    """The ``k`` most frequent values of each column of (``column``, ``value``), ties by value, with ``count`` and ``rank``.

    Values are counted by bucket, which bounds what is shuffled whatever the number of distinct values.
    Then only the values of the heaviest buckets are counted one by one. No value of another bucket can be
    more frequent than its bucket: if the k-th value found beats the heaviest bucket left out, nothing is
    missing. Columns for which this does not hold look into more buckets, and at last into all of them.
    The driver sees ``k`` rows a column.
    """
    dealt = values.withColumn(BUCKET, _bucket(buckets))
    by_weight = Window.partitionBy(COLUMN).orderBy(F.desc("weight"), F.asc(BUCKET))
    counts = dealt.groupBy(COLUMN, BUCKET).agg(F.count("*").alias("weight"))
    # At most ``buckets`` rows a column.
    placed = stage(counts.withColumn("place", F.row_number().over(by_weight)), "buckets")
    open_columns, taken, found = None, first * k, []
    while True:
        rows, places = dealt, placed
        if open_columns is not None:
            rows, places = (x.where(F.col(COLUMN).isin(open_columns)) for x in (rows, places))
        bounds = {}
        if taken < buckets:
            chosen = F.broadcast(places.where(F.col("place") <= taken).select(COLUMN, BUCKET))
            rows = rows.join(chosen, [COLUMN, BUCKET], "left_semi")
            # One row a column.
            bounds = dict(places.where(F.col("place") == taken + 1).select(COLUMN, "weight").collect())
        # ``k`` rows a column.
        top = _ranked(rows.groupBy(COLUMN, VALUE).count()).where(F.col("rank") <= k).collect()
        last = {r[COLUMN]: r["count"] for r in top if r["rank"] == k}
        unproved = [c for c, bound in bounds.items() if last.get(c, 0) <= bound]
        found += [r for r in top if r[COLUMN] not in unproved]
        if not unproved:
            return small_table(values.sparkSession, found, f"{COLUMN} string, {VALUE} string, count bigint, rank int")
        open_columns, taken = unproved, min(taken * MORE, buckets)


def as_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every value of the columns as text, by column."""
    text = [F.col(c).cast("string").alias(c) for c in columns]
    return df.select(*text).unpivot([], list(columns), COLUMN, VALUE)
