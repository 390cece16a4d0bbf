"""Global row numbers and row-framed windows without a single-task stage."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.plans.small import small_table
from flowlens.plans.staging import stage

# monotonically_increasing_id keeps the partition in the bits above this one.
_PARTITION_BIT = 33
_SLOT, _PART, _OFFSET = "_slot", "_part", "_offset"

FRAME, HOME = "_frame", "_home"
FRAME_ROWS = 1 << 20


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column] = (),
    name: str = "row_index",
    total_order: bool = False,
) -> tuple[DataFrame, int]:
    """Number all rows 1..n in ``order``; returns the numbered rows and n.

    Rows are range-partitioned, sorted inside each partition and written once
    with their partition and position. Only the partition sizes reach the
    driver: one number per partition, whatever the data size.

    Rows that tie on ``order`` would share one range partition. Unless the
    caller states that the order is total, every row first gets a written
    arrival number as the last sort key, so that ties are split as well.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order]
    arrival = "_arrival"
    if keys and not total_order:
        df = stage(df.withColumn(arrival, F.monotonically_increasing_id()), "arrival")
        keys = [*keys, F.col(arrival)]
    if keys:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(df.drop(arrival).withColumn(_SLOT, F.monotonically_increasing_id()), "placed")

    part = F.shiftright(_SLOT, _PARTITION_BIT)
    sizes = sorted(placed.groupBy(part.alias(_PART)).count().collect())
    starts = [0, *accumulate(size for _, size in sizes)]
    offsets = small_table(
        placed.sparkSession,
        [(row[_PART], start) for row, start in zip(sizes, starts)],
        f"{_PART} bigint, {_OFFSET} bigint",
    )
    position = F.col(_SLOT).bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    # One row per partition of the written table, so broadcasting is safe.
    numbered = (
        placed.withColumn(_PART, part)
        .join(F.broadcast(offsets), _PART)
        .withColumn(name, position + F.col(_OFFSET) + 1)
        .drop(_PART, _OFFSET, _SLOT)
    )
    return numbered, starts[-1]


def frame_size(df: DataFrame, rows: int, reach: int) -> int:
    """Rows per frame: enough frames to occupy the cluster, each much wider than its halo."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(min(FRAME_ROWS, -(-rows // tasks)), 8 * reach, 1)


def with_frames(df: DataFrame, index: str, before: int, after: int, size: int) -> DataFrame:
    """Cut a numbered table into frames of ``size`` rows with overlapping edges.

    A row belongs to its home frame, and is copied to a neighbour when one of
    the neighbour's rows can see it through a window of ``before`` preceding
    and ``after`` following rows. Windows partitioned by ``FRAME`` then give
    the same values as one global window for the rows where ``HOME`` is true.
    """
    if size < max(before, after):
        raise ValueError("a frame must be at least as long as the window reaches")
    home = F.floor((F.col(index) - 1) / size)
    position = F.pmod(F.col(index) - 1, F.lit(size))
    frames = F.array_compact(
        F.array(
            home,
            F.when(position < after, home - 1),
            F.when(position >= size - before, home + 1),
        )
    )
    return df.withColumn(FRAME, F.explode(frames)).withColumn(HOME, F.col(FRAME) == home)
