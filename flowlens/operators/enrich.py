"""Enrichment from reference tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.columns import ip_number, plain_name
from flowlens.functions.fixed import UNKNOWN
from flowlens.operators.balance import union_all
from flowlens.plans.membership import filter_words, key_filter, possible_members
from flowlens.plans.nesting import disjoint
from flowlens.plans.ordering import FRAME, HOME, frame_size, number_rows, with_frames
from flowlens.plans.skew import BROADCAST_ROWS, fits, lookup_join
from flowlens.plans.staging import stage
from flowlens.roles import Roles

GEO_COLUMNS = ("country", "city", "latitude", "longitude")
OWNER_COLUMNS = ("asn", "organization", "isp")

# A range is filed under the cells of the narrowest grid on which it covers at
# most _MAX_CELLS + 1 cells. Grid widths are powers of two, given by shift.
_SHIFTS = range(0, 64, 4)
_MAX_CELLS = 16
# From this shift on, IPv4 has room for less than 70,000 ranges in all.
_WIDE = 16
WIDE_ROWS = 70_000 * (_MAX_CELLS + 1)
_LEVEL, _CELL, _KEY, _POINT, _LO, _HI = "_level", "_cell", "_key", "_point", "_lo", "_hi"


def _check_disjoint(ranges: DataFrame, broadcast_rows: int) -> None:
    """Raise when two ranges share a value, comparing neighbours in order."""
    if fits(ranges, broadcast_rows):
        # Bounded by the check above.
        ordered = ranges.withColumn(FRAME, F.lit(0)).withColumn(HOME, F.lit(True))
        rows = Window.partitionBy(FRAME).orderBy(_LO, _HI)
    else:
        numbered, n = number_rows(ranges, [_LO, _HI], "_row")
        ordered = with_frames(numbered, "_row", 1, 0, frame_size(ranges, n, 1))
        rows = Window.partitionBy(FRAME).orderBy("_row")
    overlap = F.lag(_HI).over(rows) >= F.col(_LO)
    bad = ordered.withColumn("_bad", overlap | (F.col(_LO) > F.col(_HI)))
    if not bad.filter(F.col(HOME) & F.col("_bad")).isEmpty():
        raise ValueError("ranges must run from low to high and must not overlap")


def _on_grids(ranges: DataFrame) -> DataFrame:
    """Each range once per grid cell it touches, at most ``_MAX_CELLS + 1`` rows.

    Ranges on a grid are wider than its cells and disjoint, so a cell holds
    at most two of them: a look-up never meets more than two candidates.
    """
    level = F.coalesce(
        *(
            F.when(F.shiftright(_HI, s) - F.shiftright(_LO, s) <= _MAX_CELLS, s)
            for s in _SHIFTS
        )
    )
    cells = F.expr(f"sequence(shiftright({_LO}, {_LEVEL}), shiftright({_HI}, {_LEVEL}))")
    return ranges.withColumn(_LEVEL, level).withColumn(_CELL, F.explode(cells))


def range_lookup(
    df: DataFrame,
    ranges: DataFrame,
    point: Column,
    broadcast_rows: int = BROADCAST_ROWS,
    number: Callable[[Column], Column] = lambda point: point,
) -> DataFrame:
    """Left join of ``point`` to the range ``lo..hi`` that contains its ``number``.

    A small range table is broadcast grid by grid and no row moves. With a
    larger one, points are counted in one pass, each distinct one is looked up
    once, by equality on its grid cell, and the answers are joined back. So the
    number is worked out once a distinct point, not once a row.
    """
    values = [c for c in ranges.columns if c not in ("lo", "hi")]
    # A second look-up replaces the first.
    df = df.drop(*values).withColumn(_KEY, point)
    bounds = ranges.select(
        F.col("lo").cast("bigint").alias(_LO), F.col("hi").cast("bigint").alias(_HI), *values
    )
    _check_disjoint(bounds.select(_LO, _HI), broadcast_rows)
    grids = _on_grids(bounds)
    # At most one level per entry of _SHIFTS.
    levels = sorted(row[0] for row in grids.select(_LEVEL).distinct().collect())
    columns = [c for c in df.columns if c != _KEY]
    within = F.col(_POINT).between(F.col(_LO), F.col(_HI))

    if not levels:
        kinds = dict(ranges.dtypes)
        return df.drop(_KEY).withColumns({v: F.lit(None).cast(kinds[v]) for v in values})
    if fits(grids, broadcast_rows):
        found, points = [], df.withColumn(_POINT, number(F.col(_KEY)))
        for level in levels:
            hit = f"_hit{level}"
            grid = grids.filter(F.col(_LEVEL) == level).select(
                _CELL, _LO, _HI, F.struct(*values).alias(hit)
            )
            on = (F.shiftright(_POINT, level) == F.col(_CELL)) & within
            points = points.join(F.broadcast(grid), on, "left").drop(_CELL, _LO, _HI)
            found.append(F.col(hit))
        return points.withColumn("_hit", F.coalesce(*found)).select(*columns, "_hit.*")

    # One pass over the rows tells the points to look up, and which of them are hot.
    counted = stage(df.groupBy(_KEY).count(), "points")
    distinct = counted.select(_KEY, number(F.col(_KEY)).alias(_POINT)).dropna()

    def answered(some: list[int]) -> DataFrame:
        probes = distinct.withColumn(_LEVEL, F.explode(F.lit(some))).withColumn(
            _CELL, F.expr(f"shiftright({_POINT}, {_LEVEL})")
        )
        grid = grids.filter(F.col(_LEVEL).isin(some))
        # Cells of a wide grid can hold many points, but an address space has
        # room for few wide ranges. A narrow cell cannot hold many points.
        # Else cells are many more than the ranges that Spark sees: never broadcast.
        wide = min(some) >= _WIDE and fits(grid, WIDE_ROWS)
        grid = F.broadcast(grid) if wide else grid.hint("merge")
        return probes.join(grid, [_LEVEL, _CELL]).filter(within).select(_KEY, *values)

    groups = [[s for s in levels if s < _WIDE], [s for s in levels if s >= _WIDE]]
    answers = union_all([answered(some) for some in groups if some])
    return lookup_join(df, stage(answers, "answers"), [_KEY], broadcast_rows, counted).drop(_KEY)


def _prefixed(columns: tuple[str, ...], prefix: str) -> list[Column]:
    return [F.col(c).alias(prefix + c) for c in columns]


def enrich_geo(
    df: DataFrame,
    ranges: DataFrame | None,
    ip: str = "src_ip",
    broadcast_rows: int = BROADCAST_ROWS,
    prefix: str = "",
    nested: bool = False,
) -> DataFrame:
    """Country, city and position of an address; null where no range holds it.

    Without a range table the input is returned unchanged. Columns of the same names are replaced;
    ``prefix`` tells the two ends of a flow apart. ``nested`` ranges may lie within others, and the most
    specific one counts.
    """
    if ranges is None:
        return df
    located = ranges.select("lo", "hi", *_prefixed(GEO_COLUMNS, prefix))
    located = disjoint(located) if nested else located
    return range_lookup(df, located, F.col(ip), broadcast_rows, ip_number)


def enrich_owner(
    df: DataFrame,
    owners: DataFrame,
    ip: str = "src_ip",
    broadcast_rows: int = BROADCAST_ROWS,
    prefix: str = "",
    nested: bool = False,
) -> DataFrame:
    """Network owner of an address, from a table by ``ip`` or by ``lo``/``hi`` range.

    ``nested`` ranges may lie within others, and the most specific one counts.
    """
    if "lo" in owners.columns:
        owned = owners.select("lo", "hi", *_prefixed(OWNER_COLUMNS, prefix))
        owned = disjoint(owned) if nested else owned
        return range_lookup(df, owned, F.col(ip), broadcast_rows, ip_number)
    # One owner per address, so that the join never multiplies rows.
    owner = F.min(F.struct(*_prefixed(OWNER_COLUMNS, prefix))).alias("owner")
    unique = owners.dropna(subset=["ip"]).groupBy(F.col("ip").alias(ip)).agg(owner)
    return lookup_join(df, unique.select(ip, "owner.*"), [ip], broadcast_rows)


def occurring(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """The listed keys that occur in ``df``."""
    words = filter_words(listed.count())
    table = stage(key_filter(listed, key, words), "filter")
    candidates = possible_members(df.select(key).dropna().distinct(), key, table, words)
    return stage(candidates.join(listed, key, "left_semi"), "occurring")


def flag_threats(
    df: DataFrame, blocklist: DataFrame, ip: str = "src_ip", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``is_malicious_ip``: whether the address is on the block-list.

    A list too large to broadcast is first cut down to the addresses that occur: distinct addresses pass a
    filter of the list, whose size is bounded, and only those that may be listed are shuffled to meet it.
    """
    listed = blocklist.select(F.col("ip").alias(ip)).dropna().distinct()
    if not fits(listed, broadcast_rows):
        listed = occurring(df, stage(listed, "listed"), ip)
    marked = lookup_join(df, listed.withColumn("_listed", F.lit(True)), [ip], broadcast_rows)
    flag = F.coalesce("_listed", F.lit(False))
    return marked.withColumn("is_malicious_ip", flag).drop("_listed")


def categorize(
    df: DataFrame,
    taxonomy: DataFrame,
    roles: Roles,
    default: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``attack_category`` of the attack name; ``default`` for names not listed."""
    if not roles.has("attack"):
        return df
    key = "_attack"
    # One category per plain name, so that the join never multiplies rows.
    named = taxonomy.select(plain_name(F.col("attack")).alias(key), "category").dropna()
    names = named.groupBy(key).agg(F.min("category").alias("_category"))
    keyed = df.withColumn(key, plain_name(F.col(roles.attack)))
    joined = lookup_join(keyed, names, [key], broadcast_rows)
    category = F.col("_category") if default is None else F.coalesce("_category", F.lit(default))
    return joined.withColumn("attack_category", category).drop(key, "_category")


def categorize_or_unknown(df: DataFrame, taxonomy: DataFrame, roles: Roles) -> DataFrame:
    return categorize(df, taxonomy, roles, UNKNOWN)
