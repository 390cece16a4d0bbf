"""Sums that are the same bits whatever the order and the placing of the rows.

A number is cut into limbs of 22 bits. Limbs are whole numbers, so their sums are exact and merge in any
order, for up to 2^41 rows. Two ways to place the limbs of doubles:

* ``moments`` takes the range of a column from a first pass and cuts each number into five limbs below
  its largest one: 106 bits, so numbers down to 2^-53 of the largest one count with all their bits.
  Whole numbers are always exact. The few sums of a table are put together as fractions.
* ``exact_sum`` is an aggregate for groups and streams, with limbs at fixed places: from 2^22, above which
  parts are summed as doubles (exact up to a total of 2^75), down to 2^-88. NaN and infinities take part
  as usual.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from math import frexp, isfinite, isnan, ldexp, nan, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 22
_MASK = (1 << LIMB) - 1
_BASE = 2.0**LIMB
_FIXED = (0, -LIMB, -2 * LIMB, -3 * LIMB, -4 * LIMB)
#: Bits of a scaled double before its point, and after it.
_WHOLE, _FINE = 62, 2 * LIMB
WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")

#: Number of values, smallest and largest one.
Range = tuple[int, float | int | None, float | int | None]
#: Parts to sum, with the place of their last bit.
Parts = dict[int, Column]


def _mask() -> Column:
    return F.lit(_MASK).cast("bigint")


def _limbs(value: Column, place: int = 0) -> Parts:
    """A long in three limbs; the last bit of the long has the value 2^place."""
    return {
        place: value.bitwiseAND(_mask()),
        place + LIMB: F.shiftright(value, LIMB).bitwiseAND(_mask()),
        place + 2 * LIMB: F.shiftright(value, 2 * LIMB),
    }


def _times(value: Column, power: int) -> Column:
    """``value`` times 2^power, in two steps as the factor may be none of a double."""
    return value * 2.0 ** (power // 2) * 2.0 ** (power - power // 2)


def _scaled(value: Column, bound: int, fine: bool = True) -> Parts:
    """A double below 2^bound in limbs; without ``fine``, in the three upper ones."""
    moved = _times(value, _WHOLE - bound)
    whole = moved.cast("bigint")
    parts = _limbs(whole, bound - _WHOLE)
    if fine:
        rest = ((moved - whole.cast("double")) * 2.0**_FINE).cast("bigint")
        low = bound - _WHOLE - _FINE
        parts |= {low: rest.bitwiseAND(_mask()), low + LIMB: F.shiftright(rest, LIMB)}
    return parts


def _bound(size: float) -> int:
    """The smallest power of two above ``size``."""
    return frexp(size)[1]


def _sum_parts(value: Column, kind: str, low: float | int, high: float | int) -> Parts:
    if kind in WHOLE_TYPES:
        parts = _limbs(value.cast("bigint"))
        if max(abs(low), abs(high)) < 1 << 2 * LIMB:
            # Two limbs are enough.
            del parts[2 * LIMB]
            parts[LIMB] = F.shiftright(value.cast("bigint"), LIMB)
        return parts
    return _scaled(value.cast("double"), _bound(max(abs(low), abs(high))))


def _square_parts(value: Column, kind: str, low: float | int, high: float | int) -> tuple[Parts, float | int, int]:
    """Parts of the squared distance to a pilot, the pilot, and the power of two that scales the squares.

    The pilot is the value nearest to zero in the range. As it is an end of the range, or has values on
    both sides, the mean is at most sqrt(n) deviations away, and few digits cancel.
    """
    pilot = min(max(low, 0), high)
    reach = max(high - pilot, pilot - low)
    if kind in WHOLE_TYPES and reach < 1 << 31:
        distance = value.cast("bigint") - F.lit(pilot).cast("bigint")
        return _limbs(distance * distance), pilot, 0
    if kind in WHOLE_TYPES and reach < 1 << 63:
        distance = (value.cast("bigint") - F.lit(pilot).cast("bigint")).cast("double")
    else:
        pilot = float(pilot)
        distance = value.cast("double") - F.lit(pilot)
    scale = _bound(float(reach))
    unit = _times(distance, -scale)
    return _scaled(unit * unit, 1), pilot, 2 * scale


def _together(sums: Mapping[int, int | None]) -> Fraction:
    return sum((Fraction(s) * Fraction(2) ** place for place, s in sums.items() if s is not None), Fraction(0))


def range_of(name: str) -> list[Column]:
    """The aggregates of a ``Range``."""
    return [F.count(name), F.min(name), F.max(name)]


def ranges(df: DataFrame, columns: list[str]) -> dict[str, Range]:
    """One pass."""
    found = df.agg(*(a.alias(f"{i}_{k}") for i, c in enumerate(columns) for k, a in enumerate(range_of(c)))).first()
    return {c: tuple(found[3 * i : 3 * i + 3]) for i, c in enumerate(columns)}


def moments(df: DataFrame, found: Mapping[str, Range], deviation: bool = True) -> dict[str, tuple[float | None, float | None]]:
    """Mean and, if wanted, sample deviation of columns whose range is known; one pass, one row to the driver."""
    kinds = dict(df.dtypes)
    aggregates, squares = [], {}
    for i, (name, (n, low, high)) in enumerate(found.items()):
        if n == 0 or not (isfinite(low) and isfinite(high)):
            continue
        value = F.col(name)
        parts = {("s", place): part for place, part in _sum_parts(value, kinds[name], low, high).items()}
        if deviation and n > 1 and high > low:
            cut, *squares[name] = _square_parts(value, kinds[name], low, high)
            parts |= {("q", place): part for place, part in cut.items()}
        aggregates += [F.sum(part).alias(f"{i}:{what}:{place}") for (what, place), part in parts.items()]
    sums: dict[tuple[str, str], dict[int, int]] = {}
    if aggregates:
        names = list(found)
        for key, value in df.agg(*aggregates).first().asDict().items():
            i, what, place = key.split(":")
            sums.setdefault((names[int(i)], what), {})[int(place)] = value
    return {name: _moments_of(name, *found[name], sums, squares, deviation) for name in found}


def _root(value: Fraction) -> float:
    """The square root, also where the value itself is no double."""
    if value <= 0:
        return 0.0
    half = (value.numerator.bit_length() - value.denominator.bit_length()) // 2
    return ldexp(sqrt(value / Fraction(4) ** half), half)


def _moments_of(name, n, low, high, sums, squares, deviation) -> tuple[float | None, float | None]:
    if n == 0:
        return None, None
    if (name, "s") not in sums:  # not finite
        return nan if isnan(high) else float(low) + float(high), nan if n > 1 else None
    total = _together(sums[name, "s"])
    if not deviation or n == 1:
        return float(total / n), None
    if name not in squares:  # one value only
        return float(total / n), 0.0
    pilot, scale = squares[name]
    away = total - n * Fraction(pilot)
    spread = _together(sums[name, "q"]) * Fraction(2) ** scale - away * away / n
    return float(total / n), _root(spread / (n - 1))


# --- aggregates for groups and streams ---------------------------------------


def _carried(limbs: list[Column]) -> tuple[list[Column], Column]:
    """Limbs from the lowest, each brought into 0..2^22-1, and what is left over at the top."""
    carry, found = F.lit(0).cast("bigint"), []
    for limb in limbs:
        limb = limb + carry
        found.append(limb.bitwiseAND(_mask()))
        carry = F.shiftright(limb, LIMB)
    return found, carry


def scaled_sum(column: str, kind: str, found: Range) -> Column:
    """Aggregate: the total of a column of known finite range, whole numbers exact, doubles cut at 2^-62 of the largest."""
    _, low, high = found
    if kind in WHOLE_TYPES or low is None or not (isfinite(low) and isfinite(high)):
        return exact_sum(column, kind)
    bound = _bound(max(abs(low), abs(high)))
    parts = _scaled(F.col(column).cast("double"), bound, fine=False)
    return _joined([F.sum(parts[place]) for place in sorted(parts)], bound - _WHOLE)


def _joined(sums: list[Column], place: int) -> Column:
    """The double nearest to three summed limbs of a long."""
    (low, middle), carry = _carried(sums[:2])
    rest = middle.cast("double") * _BASE + low.cast("double")
    return _times((sums[2] + carry).cast("double") * _BASE**2 + rest, place)


def exact_sum(column: str, kind: str) -> Column:
    """Aggregate: the exact total of a column as a double, null without any value."""
    if kind in WHOLE_TYPES:
        parts = _limbs(F.col(column).cast("bigint"))
        return _joined([F.sum(parts[place]) for place in sorted(parts)], 0)
    value = F.col(column).cast("double")
    # Wider numbers have no bits below the limbs.
    narrow = F.when(F.abs(value) < _BASE * 2.0**53, value)
    top = F.sum(F.coalesce(narrow - narrow % _BASE, value))
    limbs = {w: F.coalesce(F.sum(((narrow * 2.0**-w) % _BASE).cast("bigint")), F.lit(0)) for w in _FIXED}
    lowest = 2.0 ** _FIXED[-1]
    tail = F.coalesce(F.sum(((narrow / lowest) % 1.0) * lowest), F.lit(0.0))
    rough = top
    for weight, limb in limbs.items():
        rough = rough + limb.cast("double") * 2.0**weight
    # Limbs of a negative total are carried as those of its size, so that no digits cancel.
    sign = F.when(rough < 0, F.lit(-1)).otherwise(F.lit(1))
    order = sorted(_FIXED)
    low, carry = _carried([limbs[w] * sign for w in order])
    rest = tail * sign
    for weight, limb in zip(order, low):
        rest = rest + limb.cast("double") * 2.0**weight
    return (top * sign + carry.cast("double") * _BASE + rest) * sign


def mean_of(total: Column, column: str) -> Column:
    """Aggregate: a total over the number of values."""
    return F.try_divide(total, F.count(column).cast("double"))
