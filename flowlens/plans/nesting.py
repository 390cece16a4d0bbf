"""Nested ranges made disjoint: every point belongs to the most specific range that holds it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.plans.ordering import FRAME, HOME, frame_size, number_rows, with_frames
from flowlens.plans.skew import lookup_join
from flowlens.plans.small import small_table
from flowlens.plans.staging import stage

#: Events of a chunk; one task follows the depth through it.
CHUNK_ROWS = 1 << 18
_CHUNK, _DEPTH, _OWNER = "_chunk", "_depth", "_owner"


def _events(ranges: DataFrame) -> DataFrame:
    """Both ends of every range with the keys of a sweep: ends before starts, inner ends and outer starts first."""
    def end(at: Column, opens: int, then: Column) -> Column:
        return F.struct(at.alias("_at"), F.lit(opens).alias("_opens"), then.alias("_then"))

    ends = F.array(end(F.col("lo"), 1, -F.col("hi")), end(F.col("hi") + 1, 0, -F.col("lo")))
    return ranges.select("_id", F.explode(ends).alias("end")).select("_id", "end.*")


def _with_depth(events: DataFrame, rows: int) -> DataFrame:
    """The number of open ranges after each event. The driver sees one sum a chunk."""
    step = F.when(F.col("_opens") == 1, 1).otherwise(-1).cast("bigint")
    chunked = events.select("*", F.floor((F.col("_index") - 1) / rows).alias(_CHUNK), step.alias("_step"))
    sums = sorted(chunked.groupBy(_CHUNK).agg(F.sum("_step")).collect())
    before = accumulate((total for _, total in sums), initial=0)
    offsets = small_table(
        events.sparkSession, [(row[0], start) for row, start in zip(sums, before)], f"{_CHUNK} bigint, _before bigint"
    )
    inside = F.sum("_step").over(Window.partitionBy(_CHUNK).orderBy("_index"))
    # One row per chunk.
    placed = chunked.withColumn("_inside", inside).join(F.broadcast(offsets), _CHUNK)
    return placed.withColumn(_DEPTH, F.col("_inside") + F.col("_before")).drop("_inside", "_before", "_step")


def _with_owner(deep: DataFrame) -> DataFrame:
    """The innermost open range after each event: the last one that was opened at the event's depth."""
    opened = F.when(F.col("_opens") == 1, F.col("_id"))
    level = Window.partitionBy(_CHUNK, _DEPTH).orderBy("_index")
    near = stage(deep.withColumn("_near", F.last(opened, ignorenulls=True).over(level)), "near")
    # Where nothing was opened in the chunk, an earlier chunk knows: few rows, one per chunk and depth.
    last = near.where("_opens = 1").groupBy(_CHUNK, _DEPTH).agg(F.max_by("_id", "_index").alias("_last"))
    asked = near.where(f"_near IS NULL AND {_DEPTH} > 0").select(_CHUNK, _DEPTH).distinct()
    both = last.withColumn("_asked", F.lit(False)).unionByName(
        asked.select(_CHUNK, _DEPTH, F.lit(None).cast("bigint").alias("_last"), F.lit(True).alias("_asked"))
    )
    # A chunk asks before it answers.
    earlier = Window.partitionBy(_DEPTH).orderBy(_CHUNK, F.desc("_asked")).rowsBetween(Window.unboundedPreceding, -1)
    carried = both.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).where("_asked")
    found = lookup_join(near, carried.select(_CHUNK, _DEPTH, "_carried"), [_CHUNK, _DEPTH])
    owner = F.when(F.col(_DEPTH) > 0, F.coalesce("_near", "_carried"))
    return found.withColumn(_OWNER, owner).drop("_near", "_carried")


def _refuse_crossings(ranges: DataFrame, deep: DataFrame) -> None:
    """Raise unless every range ends at the depth at which it began, runs upwards and occurs once."""
    began = deep.where("_opens = 1").select("_id", F.col(_DEPTH).alias("_began"))
    ended = deep.where("_opens = 0").select("_id", _DEPTH)
    crossing = began.join(ended, "_id").where(f"{_DEPTH} <> _began - 1")
    repeated = ranges.groupBy("lo", "hi").count().where("count > 1")
    if not crossing.isEmpty() or not repeated.isEmpty():
        raise ValueError("ranges may be nested, but must not overlap otherwise, nor occur twice")


def disjoint(ranges: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The parts of nested ranges (``lo``, ``hi``, other columns) in which each is the most specific one.

    A sweep over all ends in order. It is cut into chunks: depths inside a chunk are summed by one task, and
    carried on by one number a chunk; the owner of a part is the last range opened at its depth. Ranges that
    overlap without one holding the other are refused, and so are equal ones.
    """
    bounded = ranges.withColumns({c: F.col(c).cast("bigint") for c in ("lo", "hi")})
    bounded = stage(bounded.withColumn("_id", F.monotonically_increasing_id()), "ranges")
    if not bounded.where("lo > hi OR lo IS NULL OR hi IS NULL").isEmpty():
        raise ValueError("ranges must run from low to high")
    order = ["_at", "_opens", "_then", "_id"]
    numbered, n = number_rows(_events(bounded), order, "_index", total_order=True)
    deep = stage(_with_depth(numbered, chunk_rows), "depths")
    _refuse_crossings(bounded, deep)
    owned = _with_owner(deep)
    framed = with_frames(owned.select("_index", "_at", _OWNER), "_index", 0, 1, frame_size(owned, n, 1))
    following = F.lead("_at").over(Window.partitionBy(FRAME).orderBy("_index"))
    parts = framed.withColumn("_next", following).where(F.col(HOME) & F.col(_OWNER).isNotNull() & (F.col("_next") > F.col("_at")))
    parts = parts.select(F.col(_OWNER).alias("_id"), F.col("_at").alias("lo"), (F.col("_next") - 1).alias("hi"))
    found = parts.join(bounded.drop("lo", "hi"), "_id").select(*ranges.columns)
    return stage(found, "disjoint")
