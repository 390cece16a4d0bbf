"""How attacks, hosts and connections behave."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import is_attack, is_dos, is_probe, share
from flowlens.operators.clean import quantiles
from flowlens.operators.distribution import TOP_HOSTS, top_k
from flowlens.plans import exact
from flowlens.plans.measures import Measure, measure
from flowlens.plans.small import small_table
from flowlens.roles import Roles

HIGH_FREQUENCY_QUANTILE = 0.95
HIGH_ERROR_RATE = 0.5


def dos_rows(df: DataFrame, roles: Roles) -> DataFrame:
    return df.filter(is_dos(roles))


def probe_rows(df: DataFrame, roles: Roles) -> DataFrame:
    return df.filter(is_probe(roles))


def attack_rows(df: DataFrame, roles: Roles) -> DataFrame:
    return df.filter(is_attack(roles))


def _family(df: DataFrame, columns: dict[str, str], where: Column) -> Measure:
    """Exact means of the columns over the rows that ``where`` keeps, and their number."""
    kinds = dict(df.dtypes)
    # Sums of whole numbers are exact in the first pass; only others need their range before they are summed.
    whole = {role: name for role, name in columns.items() if kinds[name] in exact.WHOLE_TYPES}
    others = {role: name for role, name in columns.items() if role not in whole}
    statistics = (F.count, F.min, F.max)
    aggregates = {"count": lambda keep: F.count(keep(F.lit(1)))}

    def of(name: str, statistic):
        return lambda keep: statistic(keep(F.col(name)))

    for role, name in whole.items():
        aggregates[f"{role}__n"] = of(name, F.count)
        aggregates[f"{role}__sum"] = of(name, lambda value: F.sum(value.cast("decimal(20,0)")))
    for role, name in others.items():
        aggregates |= {f"{role}__{i}": of(name, statistic) for i, statistic in enumerate(statistics)}

    def shape(row: DataFrame) -> DataFrame:
        # One row, whatever the size of the table.
        found = row.first()
        means = {name: None for name in columns.values()}
        for role, name in whole.items():
            if found[f"{role}__n"]:
                means[name] = float(Fraction(int(found[f"{role}__sum"]), found[f"{role}__n"]))
        ranges = {name: tuple(found[f"{role}__{i}"] for i in range(3)) for role, name in others.items()}
        if others:
            means |= {name: mean for name, (mean, _) in exact.moments(df.filter(where), ranges, deviation=False).items()}
        report = [tuple(means[name] for name in columns.values()) + (found["count"],)]
        schema = ", ".join(f"avg_{role} double" for role in columns) + ", count bigint"
        return small_table(row.sparkSession, report if found["count"] else [], schema)

    return Measure(aggregates, shape, where)


def dos_measure(df: DataFrame, roles: Roles) -> Measure:
    names = ("src_bytes", "dst_bytes", "duration")
    return _family(df, dict(zip(names, roles.need(*names))), is_dos(roles))


def dos_profile(df: DataFrame, roles: Roles) -> DataFrame:
    """Mean bytes and duration of denial-of-service rows; no row without any."""
    return measure(df, dos_measure(df, roles))


def probe_measure(df: DataFrame, roles: Roles) -> Measure:
    names = [n for n in ("count", "srv_count", "dst_host_count") if roles.has(n)]
    return _family(df, {n: getattr(roles, n) for n in names}, is_probe(roles))


def probe_profile(df: DataFrame, roles: Roles) -> DataFrame:
    """Mean connection counters of probing rows, for the counters the table has."""
    return measure(df, probe_measure(df, roles))


def _duration_sum(df: DataFrame, duration: str) -> tuple[Column, Column]:
    """Aggregates: total and number of durations; the total is placed by the range of the column."""
    kind = dict(df.dtypes)[duration]
    found = (0, None, None) if kind in exact.WHOLE_TYPES else exact.ranges(df, [duration])[duration]
    return exact.scaled_sum(duration, kind, found), F.count(duration)


def host_pairs(df: DataFrame, roles: Roles) -> DataFrame:
    """Per (source, destination) sums from which all host rankings follow."""
    src, dst, src_bytes, dst_bytes = roles.need("src", "dst", "src_bytes", "dst_bytes")
    (duration,) = roles.need("duration")
    total, timed = _duration_sum(df, duration)
    return df.groupBy(src, dst).agg(
        F.count("*").alias("connection_count"),
        F.sum(F.col(src_bytes).cast("bigint")).alias("total_src_bytes"),
        F.sum(F.col(dst_bytes).cast("bigint")).alias("total_dst_bytes"),
        total.alias("total_duration"),
        timed.alias("timed_connections"),
    )


def _host_sums(df: DataFrame, host: str, sums: dict[str, str], paired: bool) -> DataFrame:
    """Connections and byte sums per host, from rows or from ``host_pairs``."""
    if paired:
        connections = F.sum("connection_count")
        totals = [F.sum(total).alias(total) for total in sums]
    else:
        connections = F.count("*")
        totals = [F.sum(F.col(c).cast("bigint")).alias(total) for total, c in sums.items()]
    return df.groupBy(host).agg(connections.alias("connection_count"), *totals)


def top_sources(
    df: DataFrame, roles: Roles, k: int = TOP_HOSTS, paired: bool = False
) -> DataFrame:
    """Sources with most connections, and their bytes both ways.

    ``paired``: ``df`` is the result of ``host_pairs``.
    """
    src, src_bytes, dst_bytes = roles.need("src", "src_bytes", "dst_bytes")
    sums = {"total_src_bytes": src_bytes, "total_dst_bytes": dst_bytes}
    return top_k(_host_sums(df, src, sums, paired), "connection_count", [src], k)


def top_destinations(
    df: DataFrame, roles: Roles, k: int = TOP_HOSTS, paired: bool = False
) -> DataFrame:
    """Destinations with most connections, and the bytes they sent."""
    dst, dst_bytes = roles.need("dst", "dst_bytes")
    hosts = _host_sums(df, dst, {"total_dst_bytes": dst_bytes}, paired)
    return top_k(hosts, "connection_count", [dst], k)


def top_pairs(
    df: DataFrame, roles: Roles, k: int = TOP_HOSTS, paired: bool = False
) -> DataFrame:
    """Host pairs with most connections, and their mean duration."""
    src, dst, duration = roles.need("src", "dst", "duration")
    if paired:
        mean = F.try_divide("total_duration", "timed_connections")
        pairs = df.select(src, dst, "connection_count", mean.alias("avg_duration"))
    else:
        total, timed = _duration_sum(df, duration)
        pairs = df.groupBy(src, dst).agg(
            F.count("*").alias("connection_count"),
            F.try_divide(total, timed.cast("double")).alias("avg_duration"),
        )
    return top_k(pairs, "connection_count", [src, dst], k)


def _part_of_rows(condition: Column) -> Measure:
    return Measure(
        {
            "count": lambda keep: F.count_if(keep(condition)),
            "total": lambda keep: F.count(keep(F.lit(1))),
        },
        lambda row: row.select("count", share(F.col("count"), F.col("total")).alias("share")),
    )


def high_frequency(
    df: DataFrame, col: str, q: float = HIGH_FREQUENCY_QUANTILE, rel_error: float = 0.01
) -> DataFrame:
    """Rows whose ``col`` lies strictly above its ``q`` quantile."""
    found = quantiles(df, col, [q], rel_error)
    threshold = F.lit(found[0] if found else None).cast("double")
    part = measure(df, _part_of_rows(F.col(col) > threshold))
    return part.select(threshold.alias("threshold"), "count", "share")


def high_error_measure(cols: Sequence[str], t: float = HIGH_ERROR_RATE) -> Measure:
    first, *rest = (F.col(c) > t for c in cols)
    for test in rest:
        first = first | test
    return _part_of_rows(first)


def high_error(df: DataFrame, cols: Sequence[str], t: float = HIGH_ERROR_RATE) -> DataFrame:
    """Rows with any of the error rates above ``t``."""
    return measure(df, high_error_measure(cols, t))
