"""Derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import (
    byte_sum,
    normalized_category,
    plain_name,
    ratio_or_zero,
    segment_name,
)
from flowlens.functions.fixed import NORMAL
from flowlens.roles import Roles


def binary_label(df: DataFrame, attack: str = "attack_type") -> DataFrame:
    """``label``: 0 for normal traffic, 1 for anything else, null included."""
    normal = plain_name(F.col(attack)) == NORMAL
    return df.withColumn("label", F.when(normal, 0).otherwise(1))


def attack_category(df: DataFrame, roles: Roles) -> DataFrame:
    """``attack_category`` from the category column, else from the label."""
    if "attack_category" in df.columns:
        return df
    source = roles.category or roles.need("label")[0]
    category = normalized_category(F.col(source).cast("string"))
    return df.withColumn("attack_category", category)


def time_features(df: DataFrame, roles: Roles) -> DataFrame:
    """``hour``, ``day_of_week`` (1 = Sunday) and ``is_weekend`` of the time stamp."""
    (ts,) = roles.need("ts")
    weekday = F.dayofweek(ts)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": weekday,
            "is_weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
        }
    )


def total_bytes(df: DataFrame, roles: Roles) -> DataFrame:
    return df.withColumn("total_bytes", byte_sum(roles))


def bytes_ratio(df: DataFrame, roles: Roles) -> DataFrame:
    """Source bytes per destination byte, 0 without destination bytes."""
    src, dst = roles.need("src_bytes", "dst_bytes")
    return df.withColumn("bytes_ratio", ratio_or_zero(F.col(src), F.col(dst)))


def connection_intensity(df: DataFrame, roles: Roles) -> DataFrame:
    count, srv_count = roles.need("count", "srv_count")
    return df.withColumn("connection_intensity", F.col(count) + F.col(srv_count))


def traffic_segment(df: DataFrame, roles: Roles, drop_null: bool = False) -> DataFrame:
    """``traffic_segment``: the size class of the byte total."""
    total = byte_sum(roles)
    if drop_null:
        df = df.filter(total.isNotNull())
    return df.withColumn("traffic_segment", segment_name(total))


def bytes_per_connection(df: DataFrame) -> DataFrame:
    ratio = ratio_or_zero(F.col("total_src_bytes"), F.col("connection_count"))
    return df.withColumn("bytes_per_connection", ratio)


def features(df: DataFrame, roles: Roles) -> DataFrame:
    """Every derived feature whose input columns the table has."""
    if roles.has("ts"):
        df = time_features(df, roles)
    if roles.has("src_bytes", "dst_bytes"):
        df = bytes_ratio(total_bytes(df, roles), roles)
    if roles.has("count", "srv_count"):
        df = connection_intensity(df, roles)
    return df
