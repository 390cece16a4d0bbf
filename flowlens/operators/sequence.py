"""Ordered analyses: trends over all rows, gaps and event sequences per source."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from flowlens.functions.fixed import SEQUENCE_MIN_CHARS, SEQUENCE_SEPARATOR, SEQUENCE_STEPS
from flowlens.plans.ordering import FRAME, HOME, frame_size, number_rows, with_frames
from flowlens.plans.skew import keys_above, split_hot
from flowlens.roles import Roles

HALF_WIDTH = 100
TREND_POINTS, TREND_STEP = 100, 10
# A source with more rows than this is cut into frames instead of one window.
HOT_ROWS = 4_000_000
INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def time_index(
    df: DataFrame, order: Sequence[str], total_order: bool = False, name: str = "time_index"
) -> DataFrame:
    """``time_index``: 1..n over all rows in ``order``."""
    return number_rows(df, order, name, total_order)[0]


def _with_centred_mean(
    df: DataFrame, value: str, rows: WindowSpec, half: int, name: str
) -> DataFrame:
    """Add the mean over ``half`` rows on either side of each row.

    Whole numbers go through running sums, two look-ups a row instead of
    ``2 * half + 1`` additions; fractions would lose digits that way.
    """
    if dict(df.dtypes)[value] not in INTEGRAL:
        return df.withColumn(name, F.avg(value).over(rows.rowsBetween(-half, half)))

    amounts = {
        "_sum": F.coalesce(F.col(value).cast("bigint"), F.lit(0)),
        "_known": F.col(value).isNotNull().cast("bigint"),
    }
    sofar = rows.rowsBetween(Window.unboundedPreceding, 0)
    whole = rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = df.withColumns(
        {key: F.sum(amount).over(sofar) for key, amount in amounts.items()}
        | {f"{key}_all": F.sum(amount).over(whole) for key, amount in amounts.items()}
    )

    def around(key: str) -> Column:
        upto = F.coalesce(F.lead(key, half).over(rows), f"{key}_all")
        return upto - F.coalesce(F.lag(key, half + 1).over(rows), F.lit(0))

    mean = F.try_divide(around("_sum").cast("double"), around("_known").cast("double"))
    return running.withColumn(name, mean).select(*df.columns, name)


def moving_average(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    half: int = HALF_WIDTH,
    total_order: bool = False,
    name: str = "bytes_moving_avg",
) -> DataFrame:
    """``time_index`` and the centred moving average of ``value`` over all rows."""
    columns = df.columns
    numbered, rows = number_rows(df, order, "time_index", total_order)
    size = frame_size(df, rows, half)
    framed = with_frames(numbered, "time_index", half, half, size)
    rows_in_frame = Window.partitionBy(FRAME).orderBy("time_index")
    averaged = _with_centred_mean(framed, value, rows_in_frame, half, name)
    return averaged.filter(HOME).select(*columns, "time_index", name)


def trend_points(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    n: int = TREND_POINTS,
    step: int = TREND_STEP,
    half: int = HALF_WIDTH,
    name: str = "bytes_moving_avg",
    span: Literal["head", "all"] = "head",
    total_order: bool = False,
) -> DataFrame:
    """The moving average at chosen rows.

    ``head``: at every ``step``-th row, the first ``n`` points. Only the first
    ``n * step + half`` rows can matter. They are found by a bounded top-k over
    the rows, so nothing else is sorted or numbered. ``all``: at ``n`` evenly
    spaced rows from the first part of the order to its last row.
    """
    if span == "all":
        averaged = moving_average(df.select(*order, value), value, order, half, total_order, name)
        rows = df.count()
        # The row at which the k-th of n equal parts ends.
        part = F.ceil(F.col("time_index") * n / F.lit(max(rows, 1)))
        ends = F.floor(part * rows / F.lit(n)) == F.col("time_index")
        return averaged.filter(ends).select("time_index", name)
    head = df.select(*order, value).orderBy(*order).limit(n * step + half)
    rows = Window.partitionBy(F.lit(0)).orderBy(*order)
    indexed = head.withColumn("time_index", F.row_number().over(rows).cast("bigint"))
    return (
        _with_centred_mean(indexed, value, rows, half, name)
        .filter((F.col("time_index") % step == 0) & (F.col("time_index") <= n * step))
        .select("time_index", name)
    )


def over_sources(
    df: DataFrame,
    src: str,
    order: Sequence[str],
    before: int,
    add: Callable[[WindowSpec], dict[str, Column]],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Window columns per source that look back at most ``before`` rows.

    Sources of ordinary size share one shuffle by source. Those with more
    than ``hot_rows`` rows are numbered in (source, order) and cut into frames
    that overlap by ``before`` rows, so no source is bound to a single task.
    """
    columns = df.columns
    hot = keys_above(df, [src], hot_rows)
    if hot is None:
        return df.withColumns(add(Window.partitionBy(src).orderBy(*order)))
    hot_part, rest = split_hot(df, hot, [src])
    numbered, rows = number_rows(hot_part, [src, *order], "_row")
    size = frame_size(df, rows, before)
    framed = with_frames(numbered, "_row", before, 0, size)
    added = add(Window.partitionBy(FRAME, src).orderBy("_row"))
    hot_done = framed.withColumns(added).filter(HOME).select(*columns, *added)
    return rest.withColumns(add(Window.partitionBy(src).orderBy(*order))).unionByName(hot_done)


def _gap_columns(ts: str) -> Callable[[WindowSpec], dict[str, Column]]:
    def add(rows: WindowSpec) -> dict[str, Column]:
        previous = F.lag(ts).over(rows)
        return {
            "prev_time": previous,
            "time_diff": F.unix_timestamp(ts) - F.unix_timestamp(previous),
        }

    return add


def _sequence_columns(event: str, n: int) -> Callable[[WindowSpec], dict[str, Column]]:
    def add(rows: WindowSpec) -> dict[str, Column]:
        recent = F.collect_list(event).over(rows.rowsBetween(1 - n, 0))
        return {"attack_sequence": F.concat_ws(SEQUENCE_SEPARATOR, recent)}

    return add


def gaps(
    df: DataFrame, roles: Roles, tiebreak: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``prev_time`` of the same source and ``time_diff`` in whole seconds."""
    src, ts = roles.need("src", "ts")
    return over_sources(df, src, [ts, *tiebreak], 1, _gap_columns(ts), hot_rows)


def rolling_sequence(
    df: DataFrame,
    roles: Roles,
    n: int = SEQUENCE_STEPS,
    tiebreak: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``attack_sequence``: the last ``n`` events of the source, oldest first."""
    src, ts, event = roles.need("src", "ts", "attack")
    return over_sources(df, src, [ts, *tiebreak], n - 1, _sequence_columns(event, n), hot_rows)


def correlate(
    df: DataFrame,
    roles: Roles,
    n: int = SEQUENCE_STEPS,
    tiebreak: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Gaps and rolling sequences together, over one shared sort."""
    src, ts, event = roles.need("src", "ts", "attack")
    parts = (_gap_columns(ts), _sequence_columns(event, n))

    def add(rows: WindowSpec) -> dict[str, Column]:
        return {name: column for part in parts for name, column in part(rows).items()}

    return over_sources(df, src, [ts, *tiebreak], max(n - 1, 1), add, hot_rows)


def sequence_sources(
    sequences: DataFrame, roles: Roles, min_len: int = SEQUENCE_MIN_CHARS
) -> DataFrame:
    """Rows of every sequence longer than ``min_len`` characters, per sequence and source."""
    (src,) = roles.need("src")
    kept = sequences.filter(F.length("attack_sequence") > min_len)
    return kept.groupBy("attack_sequence", src).agg(F.count("*").alias("frequency"))


def sequence_totals(
    sequences: DataFrame, roles: Roles, min_len: int = SEQUENCE_MIN_CHARS
) -> DataFrame:
    """Rows and number of distinct sources of every sequence longer than ``min_len`` characters."""
    (src,) = roles.need("src")
    return (
        sequence_sources(sequences, roles, min_len)
        .groupBy("attack_sequence")
        .agg(F.sum("frequency").alias("frequency"), F.count(src).alias("source_count"))
    )


def frequent_sequences(
    sequences: DataFrame, roles: Roles, min_len: int = SEQUENCE_MIN_CHARS
) -> DataFrame:
    """``sequence_totals`` with the sorted list ``source_ips`` of all sources in the same row.

    One row holds every source of its sequence. Where a sequence can have very
    many, use ``sequence_totals`` and ``sequence_sources``, which stay flat.
    """
    (src,) = roles.need("src")
    return (
        sequence_sources(sequences, roles, min_len)
        .groupBy("attack_sequence")
        .agg(
            F.sum("frequency").alias("frequency"),
            F.count(src).alias("source_count"),
            F.array_sort(F.collect_list(src)).alias("source_ips"),
        )
    )
