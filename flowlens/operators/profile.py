"""Profile reports: size, numeric and categorical summaries, gaps, class totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import is_attack, share
from flowlens.operators.distribution import TOP_VALUES, counts, top_k, top_values
from flowlens.plans import exact
from flowlens.plans.measures import Measure, measure
from flowlens.plans.small import small_table
from flowlens.roles import Roles

NUMERIC_TYPES = ("int", "bigint", "float", "double")
# Columns of the profile, after the name of the profiled column.
PROFILE = "column string, mean double, std double, min double, max double, count bigint"
RANGE = {"count": F.count, "min": F.min, "max": F.max}


def _long_form(row: DataFrame, columns: Sequence[str], stats: dict[str, str]) -> DataFrame:
    """One output row per profiled column from a single wide row."""
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            *(F.col(f"{name}__{s}").cast(kind).alias(s) for s, kind in stats.items()),
        )
        for name in columns
    ]
    return row.select(F.inline(F.array(*entries)))


def overview_measure(df: DataFrame) -> Measure:
    return Measure(
        {"records": lambda keep: F.count(keep(F.lit(1)))},
        lambda row: row.withColumn("columns", F.lit(len(df.columns)).cast("bigint")),
    )


def overview(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return measure(df, overview_measure(df))


def numeric_columns(df: DataFrame, limit: int | None = None) -> list[str]:
    return [name for name, kind in df.dtypes if kind in NUMERIC_TYPES][:limit]


def numeric_measure(df: DataFrame, limit: int | None = None) -> Measure:
    columns = numeric_columns(df, limit)

    def of(name: str, statistic):
        return lambda keep: statistic(keep(F.col(name)))

    def shape(row: DataFrame) -> DataFrame:
        # One row, whatever the size of the table.
        found = row.first()
        ranges = {name: tuple(found[f"{name}__{s}"] for s in RANGE) for name in columns}
        moments = exact.moments(df, ranges)
        plain = lambda x: None if x is None else float(x)
        profiles = [(c, *moments[c], plain(low), plain(high), n) for c, (n, low, high) in ranges.items()]
        return small_table(row.sparkSession, profiles, PROFILE)

    return Measure({f"{name}__{s}": of(name, fn) for name in columns for s, fn in RANGE.items()}, shape)


def numeric_profile(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Mean, deviation, range and non-null count of the numeric columns, or of the first ``limit``.

    Sums are exact, so the result does not depend on files, partitions or cores. Two passes over the rows
    run at once, for ranges and for sums; each brings one row to the driver.
    """
    return measure(df, numeric_measure(df, limit))


def categorical_columns(df: DataFrame, cols: int | None = None) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"][:cols]


def categorical_top(
    df: DataFrame, cols: int | None = None, k: int = TOP_VALUES
) -> DataFrame:
    """Most frequent values of the text columns, or of the first ``cols``."""
    return top_values(df, categorical_columns(df, cols), k)


def missing_measure(df: DataFrame) -> Measure:
    columns = df.columns

    def of(name: str):
        return lambda keep: F.count_if(keep(F.col(name).isNull()))

    return Measure(
        {f"{name}__missing": of(name) for name in columns},
        lambda row: _long_form(row, columns, {"missing": "bigint"}),
    )


def missing_counts(df: DataFrame) -> DataFrame:
    """Null count of every column."""
    return measure(df, missing_measure(df))


def data_stats_measure(df: DataFrame, roles: Roles) -> Measure:
    attack = is_attack(roles)
    features = len(df.columns) - (1 if roles.has("label") else 0)

    def shape(row: DataFrame) -> DataFrame:
        return row.select(
            "total",
            "attacks",
            (F.col("total") - F.col("attacks")).alias("normal"),
            share(F.col("attacks"), F.col("total")).alias("attack_ratio"),
            F.lit(features).cast("bigint").alias("features"),
        )

    return Measure(
        {
            "total": lambda keep: F.count(keep(F.lit(1))),
            "attacks": lambda keep: F.count_if(keep(attack)),
        },
        shape,
    )


def data_stats(df: DataFrame, roles: Roles) -> DataFrame:
    """Totals by class, attack ratio and feature count."""
    return measure(df, data_stats_measure(df, roles))


def attack_type_counts(df: DataFrame, roles: Roles, weight: str | None = None) -> DataFrame:
    """Rows per attack name."""
    (attack,) = roles.need("attack")
    return top_k(counts(df, {attack: attack}, weight), "count", [attack])
