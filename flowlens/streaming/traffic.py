"""Event-time windows over event streams (and, unchanged, over tables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.derive import bytes_per_connection
from flowlens.plans.exact import exact_sum
from flowlens.roles import Roles

LATE_BOUND = "10 seconds"
WINDOW, SLIDE = "1 minute", "30 seconds"


def with_late_bound(df: DataFrame, ts: str, bound: str = LATE_BOUND) -> DataFrame:
    """Watermark on ``ts``: rows more than ``bound`` behind the newest are dropped."""
    return df.withWatermark(ts, bound)


def _window_sums(df: DataFrame, keys: list, sums: dict[str, str], duration: str, rows: Column, timed: Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        rows.alias("connection_count"),
        *(F.sum(F.col(c).cast("bigint")).alias(total) for total, c in sums.items()),
        exact_sum(duration, dict(df.dtypes)[duration]).alias("total_duration"),
        timed.alias("timed_connections"),
    )


def windowed_traffic(
    df: DataFrame, roles: Roles, size: str = WINDOW, slide: str | None = SLIDE, spread: int = 1
) -> DataFrame:
    """Connections, bytes and mean duration per sliding window and source.

    With ``spread`` above 1 the rows of a source are first summed in so many parts, placed by their
    content, and the parts of each window in a second step: a source with much of the traffic then
    occupies several tasks and state stores. Results are the same.
    """
    src, ts, src_bytes, dst_bytes, duration = roles.need(
        "src", "ts", "src_bytes", "dst_bytes", "duration"
    )
    sums = {"total_src_bytes": src_bytes, "total_dst_bytes": dst_bytes}
    keys = [F.window(ts, size, slide).alias("window"), F.col(src)]
    if spread > 1:
        part = F.pmod(F.xxhash64(*(c for c in df.columns if c != src)), F.lit(spread)).alias("_part")
        parts = _window_sums(df, [*keys, part], sums, duration, F.count("*"), F.count(duration))
        keys, sums, duration = ["window", src], {name: name for name in sums}, "total_duration"
        found = _window_sums(parts, keys, sums, duration, F.sum("connection_count"), F.sum("timed_connections"))
    else:
        found = _window_sums(df, keys, sums, duration, F.count("*"), F.count(duration))
    mean = F.try_divide("total_duration", F.col("timed_connections").cast("double"))
    columns = ["window", src, "connection_count", *sums, mean.alias("avg_duration")]
    return bytes_per_connection(found.select(*columns))


def windowed_counts(
    df: DataFrame, ts: str, flag: str | Column = "is_attack", size: str = WINDOW
) -> DataFrame:
    """Rows per tumbling window and attack flag."""
    named = flag.alias("is_attack") if isinstance(flag, Column) else F.col(flag)
    return df.groupBy(F.window(ts, size), named).count()


def window_bounds(df: DataFrame) -> DataFrame:
    """``window_start`` and ``window_end`` columns in place of the window struct."""
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *(c for c in df.columns if c != "window"),
    )
