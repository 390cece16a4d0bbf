"""Column expressions shared by the operators; all stay inside Catalyst."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.functions.fixed import (
    DOS_NAMES,
    IPV4_SHAPE,
    NORMAL,
    NORMAL_NAMES,
    PROBE_NAMES,
    SEGMENTS,
)
from flowlens.roles import Roles


def plain_name(name: Column) -> Column:
    """An attack name without the trailing dot that raw files carry."""
    return F.regexp_replace(name, r"\.$", "")


def share(part: Column, total: Column) -> Column:
    """``part / total``, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), total.cast("double")), F.lit(0.0))


def ratio_or_zero(value: Column, divisor: Column) -> Column:
    """``value / divisor`` where the divisor is positive, else 0."""
    quotient = F.try_divide(value.cast("double"), divisor.cast("double"))
    return F.when(divisor > 0, quotient).otherwise(F.lit(0.0))


def byte_sum(roles: Roles) -> Column:
    """Bytes both ways as a long, from one column when the table has it."""
    if roles.has("total_bytes"):
        return F.col(roles.total_bytes).cast("bigint")
    src, dst = roles.need("src_bytes", "dst_bytes")
    return F.col(src).cast("bigint") + F.col(dst).cast("bigint")


def segment_name(total: Column) -> Column:
    """Size class of a byte total; null lands in the last class."""
    *bounded, (_, last) = SEGMENTS
    (bound, name), *rest = bounded
    chain = F.when(total < bound, name)
    for bound, name in rest:
        chain = chain.when(total < bound, name)
    return chain.otherwise(last)


def hour_of_epoch(seconds: Column) -> Column:
    """Hour of day of epoch seconds, in the session time zone."""
    return F.hour(F.timestamp_seconds(seconds))


def hour_of(roles: Roles) -> Column:
    """Hour of day from the best time column the table has."""
    if roles.has("hour"):
        return F.col(roles.hour)
    if roles.has("ts"):
        return F.hour(roles.ts)
    return hour_of_epoch(F.col(*roles.need("epoch")))


def weekday_of(roles: Roles) -> Column:
    """Day of week (1 = Sunday) from the best time column the table has."""
    if roles.has("day_of_week"):
        return F.col(roles.day_of_week)
    if roles.has("ts"):
        return F.dayofweek(roles.ts)
    return F.dayofweek(F.timestamp_seconds(F.col(*roles.need("epoch"))))


def normalized_category(name: Column) -> Column:
    """``normal`` for a missing or differently cased normal, else the name."""
    return F.when(name.isNull() | name.isin(*NORMAL_NAMES), NORMAL).otherwise(name)


def is_attack(roles: Roles) -> Column:
    """True for rows that are not normal traffic.

    The category decides; where it is missing the attack name does, then the label. A row without
    any of them is normal.
    """
    names = []
    if roles.has("category"):
        names.append(F.col(roles.category))
    if roles.has("attack"):
        names.append(plain_name(F.col(roles.attack)))
    tests = [~name.isin(*NORMAL_NAMES) for name in names]
    if roles.has("label") or not names:
        names.append(F.col(*roles.need("label")).cast("string"))
        tests.append(~names[-1].isin("0", *NORMAL_NAMES))
    if len(tests) == 1:
        # Plain comparisons, which a scan can take over.
        return names[0].isNotNull() & tests[0]
    # The test of a missing name is null.
    return F.coalesce(*tests, F.lit(False))


def named_any(roles: Roles, names: tuple[str, ...]) -> Column:
    """True where the category or the attack name is one of ``names``."""
    tests = []
    if roles.has("category"):
        tests.append(F.col(roles.category).isin(*names))
    if roles.has("attack"):
        tests.append(plain_name(F.col(roles.attack)).isin(*names))
    if not tests:
        roles.need("category")
    return reduce(or_, tests)


def is_dos(roles: Roles) -> Column:
    return named_any(roles, DOS_NAMES)


def is_probe(roles: Roles) -> Column:
    return named_any(roles, PROBE_NAMES)


_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d{1,2})"
_IPV4_STRICT = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def is_ipv4(address: Column, strict: bool = False) -> Column:
    """Dotted-quad shape; ``strict`` also wants every octet below 256."""
    return address.rlike(_IPV4_STRICT if strict else IPV4_SHAPE)


def ip_number(address: Column) -> Column:
    """The address as a number, null when it is not a valid IPv4 address.

    The address is read once, however it was made: an expression that named it for each octet would be
    worked out anew for each, and grow too long to be compiled. An invalid address has one empty part.
    """
    parts = F.split(F.regexp_extract(address, _IPV4_STRICT, 0), r"\.")
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda number, part: number * 256 + part.try_cast("bigint"))
