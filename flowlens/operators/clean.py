"""Filters and cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.plans.quantiles import exact_quantiles, sketched_quantiles
from flowlens.roles import Roles

IMPUTED_TYPES = ("int", "float", "double")
WHISKER = 1.5
REL_ERROR = 0.01


def drop_unlabelled(df: DataFrame, roles: Roles) -> DataFrame:
    """Rows that carry a label, or an attack name where there is no label."""
    key = roles.label or roles.need("attack")[0]
    return df.dropna(subset=[key])


def impute_mean(
    df: DataFrame, cols: Sequence[str] | None = None, roles: Roles | None = None
) -> DataFrame:
    """Column means in place of null and NaN; integer columns get the truncated mean.

    All means come from one aggregation. Columns without any value stay as
    they are, and so does the label.
    """
    kinds = dict(df.dtypes)
    label = roles.label if roles else "label"
    if cols is None:
        cols = [name for name, kind in df.dtypes if kind in IMPUTED_TYPES and name != label]
    if not cols:
        return df

    def present(name: str):
        column = F.col(name)
        return column if kinds[name] == "int" else F.when(~F.isnan(column), column)

    means = df.agg(*(F.avg(present(name)).alias(name) for name in cols)).first()
    return df.withColumns(
        {
            name: F.coalesce(present(name), F.lit(means[name]).cast(kinds[name]))
            for name in cols
            if means[name] is not None
        }
    )


def quantiles(
    df: DataFrame, col: str, ps: Sequence[float], rel_error: float = REL_ERROR
) -> list[float]:
    """Quantiles of a column, with ranks within ``rel_error``; exact ones when it is 0."""
    if rel_error == 0:
        return exact_quantiles(df, col, ps)
    return [found.value for found in sketched_quantiles(df, {col: ps}, rel_error)[col]]


def whiskers(quartiles: Sequence[float]) -> tuple[float, float]:
    """Bounds 1.5 quartile ranges beyond the quartiles."""
    q1, q3 = quartiles
    reach = WHISKER * (q3 - q1)
    return q1 - reach, q3 + reach


def iqr_filter(df: DataFrame, col: str, rel_error: float = REL_ERROR) -> DataFrame:
    """Rows within 1.5 quartile ranges of the quartiles; nulls are dropped."""
    quartiles = quantiles(df, col, [0.25, 0.75], rel_error)
    if not quartiles:
        return df.filter(F.col(col).isNotNull())
    low, high = whiskers(quartiles)
    return df.filter((F.col(col) >= low) & (F.col(col) <= high))


def remove_outliers(df: DataFrame, roles: Roles, rel_error: float = REL_ERROR) -> DataFrame:
    """The quartile filter on source bytes, destination bytes and duration in turn."""
    for role in ("src_bytes", "dst_bytes", "duration"):
        name = getattr(roles, role)
        if name is not None:
            df = iqr_filter(df, name, rel_error)
    return df
