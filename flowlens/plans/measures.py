"""Scalar reports that can share one aggregation over the rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """Aggregates over all rows, and how their single row becomes a report.

    ``where`` restricts the rows: as a filter when the measure runs alone (it
    can then reach the scan), inside each aggregate when it shares a pass.
    """

    aggregates: dict[str, Callable[[Callable[[Column], Column]], Column]]
    shape: Callable[[DataFrame], DataFrame] = lambda row: row
    where: Column | None = None

    def named(self, keep: Callable[[Column], Column], prefix: str = "") -> list[Column]:
        return [build(keep).alias(prefix + name) for name, build in self.aggregates.items()]


def measure(df: DataFrame, part: Measure) -> DataFrame:
    """One report in its own pass."""
    rows = df if part.where is None else df.filter(part.where)
    return part.shape(rows.agg(*part.named(lambda value: value)))


def _keeper(where: Column | None) -> Callable[[Column], Column]:
    return (lambda value: value) if where is None else (lambda value: F.when(where, value))


def measure_together(
    df: DataFrame, parts: dict[str, Measure], hold: Callable[[DataFrame], DataFrame]
) -> dict[str, DataFrame]:
    """Several reports from one pass; ``hold`` keeps the shared one-row result."""
    columns = [
        column
        for key, part in parts.items()
        for column in part.named(_keeper(part.where), f"{key}__")
    ]
    row = hold(df.agg(*columns))
    return {
        key: part.shape(row.select(*(F.col(f"{key}__{n}").alias(n) for n in part.aggregates)))
        for key, part in parts.items()
    }
