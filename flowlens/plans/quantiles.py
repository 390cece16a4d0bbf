"""Quantiles for data of any size: exact ones by narrowing, approximate ones by mergeable sketches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells per power of e in the first pass, cells per bracket in later ones.
_LOG_CELLS = 100
_CELLS = 4096


def _log_cell(x: Column) -> Column:
    """Cell number on a signed logarithmic scale, never falling as x grows."""
    x = x.cast("double")
    return F.floor(F.signum(x) * F.log1p(F.abs(x)) * _LOG_CELLS)


def _linear_cell(x: Column, low: float, high: float) -> Column:
    if isinstance(low, int):
        # Whole numbers stay whole: doubles would merge neighbours beyond 2^53.
        step = (high - low) // _CELLS + 1
        return F.expr(f"(CAST(x AS DECIMAL(38, 0)) - {low}) div {step}")
    width = (high - low) / _CELLS
    if width == 0:
        return x
    return F.floor((x - F.lit(low)) / F.lit(width))


def _cells(values: DataFrame, cell: Column) -> list:
    return sorted(
        values.groupBy(cell.alias("cell"))
        .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        .collect(),
        key=lambda row: row["low"],
    )


def _locate(cells: list, rank: int) -> tuple[float, float, int]:
    """Value range of the cell that holds ``rank``, and the rank inside it."""
    for row in cells:
        if rank <= row["n"]:
            return row["low"], row["high"], rank
        rank -= row["n"]
    raise AssertionError("rank beyond the last row")


def exact_quantiles(df: DataFrame, col: str, ps: Sequence[float]) -> list[float]:
    """The value at rank ``ceil(p * n)`` for every p; nulls and NaN are left out.

    Each pass counts the rows per cell of a grid over the range that still
    can hold the answer (a partial aggregation over at most a few thousand
    cells) and keeps the one cell that holds the rank. Whole rows are never
    sorted, shuffled or collected. Two or three passes are usual.
    """
    whole = dict(df.dtypes)[col] in ("tinyint", "smallint", "int", "bigint")
    x = F.col(col).cast("bigint" if whole else "double")
    values = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    values = values if whole else values.filter(~F.isnan("x"))
    grid = _cells(values, _log_cell(F.col("x")))
    n = sum(row["n"] for row in grid)
    if n == 0:
        return []

    answers: dict[float, float] = {}
    open_: dict[float, tuple[float, float, int]] = {}
    for p in ps:
        rank = min(max(1, ceil(Decimal(str(p)) * n)), n)
        open_[p] = _locate(grid, rank)
    while True:
        for p, (low, high, _) in list(open_.items()):
            if low == high:
                answers[p] = open_.pop(p)[0]
        if not open_:
            return [answers[p] for p in ps]
        ranges = sorted({(low, high) for low, high, _ in open_.values()})
        # Ranges come from one grid or from cells of one range, so they are disjoint.
        which, cell, inside = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(False)
        for number, (low, high) in enumerate(ranges):
            within = F.col("x").between(low, high)
            which = F.when(within, number).otherwise(which)
            cell = F.when(within, _linear_cell(F.col("x"), low, high).cast("double")).otherwise(cell)
            inside = inside | within
        found = _cells(values.filter(inside), F.struct(which.alias("range"), cell.alias("cell")))
        for p, (low, high, rank) in open_.items():
            number = ranges.index((low, high))
            open_[p] = _locate([row for row in found if row["cell"]["range"] == number], rank)


# Sizes that a sketch can have, and the sketch's usual rank error by its size.
_SKETCH_SIZES = (8, 65_535)
_ERROR_FACTOR, _ERROR_POWER = 2.296, 0.9723
_WHOLE = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Quantile:
    """A value of the column, and the measured distance of its rank from the one asked for, as a share of the rows."""

    value: float
    error: float


def sketch_size(rel_error: float) -> int:
    """Size of a sketch whose rank error is usually within half of ``rel_error``."""
    least, most = _SKETCH_SIZES
    return min(max(ceil((2 * _ERROR_FACTOR / rel_error) ** (1 / _ERROR_POWER)), least), most)


def _known(name: str, kind: str) -> tuple[Column, str]:
    """The values a quantile is taken of, and the kind of sketch."""
    if kind in _WHOLE:
        return F.col(name).cast("bigint"), "bigint"
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value), "double"


def sketched_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], rel_error: float
) -> dict[str, list[Quantile]]:
    """Quantiles of several columns within ``rel_error`` of their rank; none for a column without values.

    One pass builds a mergeable sketch per column, a second one counts the rows around the values found, so
    the error is measured and not only likely. If one is above ``rel_error``, larger sketches are taken, and
    at last the exact quantiles. Only sketches of a bounded size and one row of counts leave the tasks.
    """
    if not 0 < rel_error < 1:
        raise ValueError("rel_error must be between 0 and 1")
    kinds = dict(df.dtypes)
    answers: dict[str, list[Quantile]] = {}
    open_, size = {c: list(ps) for c, ps in wanted.items()}, sketch_size(rel_error)
    while open_:
        found = _sketched(df, open_, kinds, size)
        answers |= {c: [] for c in open_ if found[c] is None}
        measured = _measured(df, {c: vs for c, vs in found.items() if vs is not None}, open_, kinds)
        answers |= {c: qs for c, qs in measured.items() if all(q.error <= rel_error for q in qs)}
        open_ = {c: ps for c, ps in open_.items() if c not in answers}
        if open_ and size == _SKETCH_SIZES[1]:
            return answers | {c: [Quantile(v, 0.0) for v in exact_quantiles(df, c, ps)] for c, ps in open_.items()}
        size = min(4 * size, _SKETCH_SIZES[1])
    return answers


def _sketched(df: DataFrame, wanted: Mapping[str, Sequence[float]], kinds: Mapping[str, str], size: int) -> dict:
    """Values at the wanted ranks by column; None for a column without values."""
    sketches, reads = [], []
    for i, (name, ps) in enumerate(wanted.items()):
        value, kind = _known(name, kinds[name])
        sketch = {"bigint": F.kll_sketch_agg_bigint, "double": F.kll_sketch_agg_double}[kind]
        read = {"bigint": F.kll_sketch_get_quantile_bigint, "double": F.kll_sketch_get_quantile_double}[kind]
        sketches += [sketch(value, size).alias(f"s{i}"), F.count(value).alias(f"n{i}")]
        ranks = F.array(*[F.lit(float(p)) for p in ps])
        reads.append(F.when(F.col(f"n{i}") > 0, read(F.col(f"s{i}"), ranks)).alias(f"q{i}"))
    row = df.agg(*sketches).select(*reads).first()
    return {name: row[i] for i, name in enumerate(wanted)}


def _measured(df, found: Mapping[str, list], wanted, kinds) -> dict[str, list[Quantile]]:
    """The values with the rank error that one count of the rows shows."""
    if not found:
        return {}
    counts = []
    for i, (name, values) in enumerate(found.items()):
        known, _ = _known(name, kinds[name])
        counts.append(F.count(known).alias(f"n{i}"))
        for j, value in enumerate(values):
            counts.append(F.count_if(known < F.lit(value)).alias(f"below{i}_{j}"))
            counts.append(F.count_if(known <= F.lit(value)).alias(f"upto{i}_{j}"))
    row = df.agg(*counts).first()
    answers = {}
    for i, (name, values) in enumerate(found.items()):
        answers[name] = []
        for j, (value, p) in enumerate(zip(values, wanted[name])):
            # Equal values hold all ranks from the first to the last of them.
            low, high = row[f"below{i}_{j}"] / row[f"n{i}"], row[f"upto{i}_{j}"] / row[f"n{i}"]
            answers[name].append(Quantile(value, max(0.0, low - p, p - high)))
    return answers
