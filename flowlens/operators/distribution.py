"""Row counts per value, largest first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import byte_sum, hour_of, is_attack, segment_name, weekday_of
from flowlens.plans.heavy import as_values, counted_values, heavy_values
from flowlens.roles import Roles

TOP_HOSTS = TOP_PORTS = TOP_VALUES = 10
TOP_SERVICES = 20
ROWS = "_rows"


def top_k(df: DataFrame, by: str, keys: Sequence[str], k: int | None = None) -> DataFrame:
    """Largest ``by`` first, ties by key; with ``k`` a bounded top-k per task."""
    ordered = df.orderBy(F.desc(by), *(F.asc(key) for key in keys))
    return ordered if k is None else ordered.limit(k)


def counts(df: DataFrame, keys: dict[str, Column | str], weight: str | None = None) -> DataFrame:
    """Rows per combination of the named keys.

    ``weight`` names a column that tells how many rows a row stands for (see ``cell_counts``).
    """
    named = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in keys.items()]
    rows = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(*named).agg(rows.alias("count"))


def hour_distribution(df: DataFrame, roles: Roles, weight: str | None = None) -> DataFrame:
    return counts(df, {"hour": hour_of(roles)}, weight).orderBy("hour")


def weekday_distribution(df: DataFrame, roles: Roles, weight: str | None = None) -> DataFrame:
    return counts(df, {"day_of_week": weekday_of(roles)}, weight).orderBy("day_of_week")


def protocol_distribution(
    df: DataFrame, roles: Roles, weight: str | None = None
) -> DataFrame:
    (proto,) = roles.need("proto")
    return top_k(counts(df, {proto: proto}, weight), "count", [proto])


def protocol_attack_relation(
    df: DataFrame, roles: Roles, weight: str | None = None
) -> DataFrame:
    proto, category = roles.need("proto", "category")
    cells = counts(df, {proto: proto, category: category}, weight)
    return top_k(cells, "count", [proto, category])


def service_distribution(
    df: DataFrame, roles: Roles, k: int = TOP_SERVICES, weight: str | None = None
) -> DataFrame:
    (service,) = roles.need("service")
    return top_k(counts(df, {service: service}, weight), "count", [service], k)


def label_distribution(df: DataFrame, roles: Roles, weight: str | None = None) -> DataFrame:
    (label,) = roles.need("label")
    return top_k(counts(df, {label: label}, weight), "count", [label])


def category_distribution(
    df: DataFrame, roles: Roles, weight: str | None = None
) -> DataFrame:
    (category,) = roles.need("category")
    return top_k(counts(df, {category: category}, weight), "count", [category])


def attack_hours(df: DataFrame, roles: Roles, weight: str | None = None) -> DataFrame:
    """Attack rows per hour, busiest hour first."""
    attacks = df.filter(is_attack(roles))
    return top_k(counts(attacks, {"hour": hour_of(roles)}, weight), "count", ["hour"])


def segment_distribution(
    df: DataFrame, roles: Roles, weight: str | None = None
) -> DataFrame:
    if "traffic_segment" in df.columns:
        segment = F.col("traffic_segment")
    else:
        segment = segment_name(byte_sum(roles))
    return top_k(counts(df, {"traffic_segment": segment}, weight), "count", ["traffic_segment"])


def top_values(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent values of each column (``column``, ``value``, ``count``, ``rank``).

    Runs at once, in two passes: see ``heavy_values``.
    """
    return heavy_values(as_values(df, columns), k)


def port_distribution(df: DataFrame, roles: Roles, k: int = TOP_PORTS) -> DataFrame:
    """Most frequent source and destination ports (``column``, ``value``, ``count``, ``rank``)."""
    ports = [p for p in (roles.src_port, roles.dst_port) if p is not None]
    # There are 65,536 ports, as few as there would be buckets.
    return counted_values(as_values(df, ports or list(roles.need("src_port"))), k)


def cell_counts(df: DataFrame, roles: Roles) -> DataFrame:
    """Row counts over every combination of the short-listed dimensions.

    The dimensions have few values each, so the cells are few, whatever the
    number of rows. All count distributions except ports follow from this one
    aggregate without another scan.
    """
    cells: dict[str, Column] = {}
    clock = roles.has("ts") or roles.has("epoch")
    if clock or roles.has("hour"):
        cells["hour"] = hour_of(roles)
    if clock or roles.has("day_of_week"):
        cells["day_of_week"] = weekday_of(roles)
    for role in ("proto", "service", "label", "category", "attack"):
        name = getattr(roles, role)
        if name is not None:
            cells[name] = F.col(name)
    if roles.has("total_bytes") or roles.has("src_bytes", "dst_bytes"):
        cells["traffic_segment"] = segment_name(byte_sum(roles))
    return df.groupBy(*(c.alias(n) for n, c in cells.items())).agg(F.count("*").alias(ROWS))
