"""Joins and splits that hold when a few keys own a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.plans.small import small_table

# A lookup table within both bounds is sent to every executor.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 << 20
# No more keys than this are taken for hot.
MAX_HOT = 10_000
# A key with more than this share of the rows is joined apart from the rest.
HOT_SHARE = 0.01


def _row_bytes(df: DataFrame) -> Column:
    """Rough size of a row: the length of its texts and a word or two per other column."""
    fixed, texts = 0, F.lit(0)
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            texts = texts + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        fixed += 16
    return texts + fixed


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` may be broadcast: both bounds are measured in one pass."""
    if rows <= 0:
        return False
    found = df.agg(F.count("*"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return found[0] <= rows and found[1] <= BROADCAST_BYTES


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, (left[k].eqNullSafe(right[k]) for k in keys))


def keys_above(
    df: DataFrame, keys: Sequence[str], rows: float, counted: DataFrame | None = None
) -> DataFrame | None:
    """Keys that own more than ``rows`` rows, the largest ``MAX_HOT`` at most; None without any.

    A key left out is joined or sorted like any other, and is a small part of
    the rows: less than one in ``MAX_HOT``. ``counted`` has the rows per key, if known.
    """
    names = list(keys)
    counted = df.groupBy(*names).count() if counted is None else counted
    heavy = counted.filter(F.col("count") > rows)
    found = heavy.orderBy(F.desc("count"), *names).limit(MAX_HOT).select(*names).collect()
    if not found:
        return None
    return small_table(df.sparkSession, found, df.select(*names).schema)


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a hot key (``hot`` has at most ``MAX_HOT`` of them) and the others; nulls compare equal."""
    small = F.broadcast(hot)
    on = same_keys(df, small, keys)
    return df.join(small, on, "left_semi"), df.join(small, on, "left_anti")


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a lookup table with unique ``keys``.

    Columns of ``df`` with the name of a looked-up one are replaced.

    A table within ``broadcast_rows`` (and ``BROADCAST_BYTES``) is broadcast,
    so the rows stay where they are. A larger one is shuffled, and then keys holding more than
    ``HOT_SHARE`` of the rows (at most ``1 / HOT_SHARE`` of them) are taken
    out and joined to their own few lookup rows by broadcast. ``counted`` has the
    rows per key (``count``) where they are known, and saves two passes over the rows.
    """
    names = list(keys)
    added = [c for c in dim.columns if c not in names]
    df = df.drop(*added)
    columns = [*df.columns, *added]

    def joined(rows: DataFrame, table: DataFrame) -> DataFrame:
        return rows.join(table, names, "left").select(*columns)

    if fits(dim, broadcast_rows):
        return joined(df, F.broadcast(dim))
    total = df.count() if counted is None else counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    hot = keys_above(df, names, total * HOT_SHARE, counted)
    if hot is None:
        return joined(df, dim)
    hot_rows, other_rows = split_hot(df, hot, names)
    hot_dim = dim.join(F.broadcast(hot), names, "left_semi")
    return joined(other_rows, dim).unionByName(joined(hot_rows, F.broadcast(hot_dim)))
