"""Class balance and oversampling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.plans.ordering import number_rows
from flowlens.plans.skew import lookup_join
from flowlens.plans.staging import stage

IMBALANCE = 5
SEED = 42
# Multiplier, addend and modulus of the drawn row numbers.
DRAW_A, DRAW_C, DRAW_M = 1_103_515_245, 12_345, 2_147_483_647
# More copies of one row, or draws of one class, than this are made by several tasks.
COPIES_PER_TASK = 100_000


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Class count, largest and smallest class, and whether oversampling is due.

    Rows without a label are of no class.
    """
    classes = df.dropna(subset=[label]).groupBy(label).agg(F.count("*").alias("n"))
    ratio = F.col("largest") / F.col("smallest")
    return (
        classes.agg(
            F.count("*").alias("classes"),
            F.max("n").alias("largest"),
            F.min("n").alias("smallest"),
        )
        .withColumn("ratio", F.when(F.col("classes") > 0, ratio))
        .withColumn(
            "oversample",
            F.coalesce((F.col("classes") >= 2) & (F.col("ratio") > IMBALANCE), F.lit(False)),
        )
    )


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def _in_pieces(df: DataFrame, pieces: Column) -> DataFrame:
    """Each row ``pieces`` times, dealt out over all tasks, numbered by ``_piece`` from 0.

    For rows due for so many copies that one task should not make them all.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbers = F.sequence(F.lit(0).cast("bigint"), pieces.cast("bigint") - 1)
    return df.withColumn("_piece", F.explode(numbers)).repartition(tasks)


def _repeat_in_order(
    numbered: DataFrame, plan: DataFrame, label: str, top: int, least: int, per_task: int
) -> DataFrame:
    """Every row ``top // n`` times, and the first ``top % n`` rows once more."""
    columns = [c for c in numbered.columns if c != "_rank"]
    one_more = (F.col("_rank") - F.col("_first") < F.lit(top) % F.col("_n")).cast("bigint")
    due = lookup_join(numbered, plan, [label]).select(
        *columns, (F.floor(F.lit(top) / F.col("_n")) + one_more).alias("_copies")
    )
    here = F.col("_copies")
    if top // least >= per_task:
        due = _in_pieces(due, F.ceil(F.col("_copies") / per_task))
        here = F.least(F.col("_copies") - F.col("_piece") * per_task, F.lit(per_task))
    return due.withColumn("_copy", F.explode(F.sequence(F.lit(1), here))).select(*columns)


def _draw(numbered: DataFrame, plan: DataFrame, top: int, seed: int, per_task: int) -> DataFrame:
    """``top`` rows of each class, drawn with replacement by a fixed formula of the draw's number.

    All classes are drawn in one pass: row numbers first, then one join to the numbered rows.
    """
    columns = [c for c in numbered.columns if c != "_rank"]
    pieces = _in_pieces(plan, F.lit(-(-top // per_task)))
    start = F.col("_piece") * per_task
    draws = F.sequence(start, F.least(start + per_task, F.lit(top)) - 1)
    drawn = pieces.select("_first", "_n", F.explode(draws).alias("_j"))
    place = (F.col("_j") % DRAW_M * DRAW_A + seed * DRAW_C) % DRAW_M % F.col("_n")
    ranks = drawn.select((F.col("_first") + place).alias("_rank"))
    # The draws are as many as rows, but seem as few as the pieces they come from: never broadcast.
    return ranks.hint("merge").join(numbered, "_rank").select(*columns)


def oversample(
    df: DataFrame,
    label: str,
    mode: Literal["exact", "drawn"] = "exact",
    order: Sequence[str] = (),
    total_order: bool = False,
    seed: int = SEED,
    only_if_imbalanced: bool = True,
    copies_per_task: int = COPIES_PER_TASK,
) -> DataFrame:
    """Bring every class up to exactly the size of the largest one.

    ``exact`` repeats rows evenly, the remainder going to the first rows by
    ``order``; ``drawn`` draws them with replacement, by their place in
    ``order``. Rows without a label go. Class sizes stay a table, so there may
    be any number of classes, and the number of jobs does not depend on it.
    """
    labelled = df.dropna(subset=[label])
    sizes = stage(labelled.groupBy(label).agg(F.count("*").alias("_n")), "classes")
    found = sizes.agg(F.count("*"), F.max("_n"), F.min("_n")).first()
    classes, top, least = found
    if classes < 2 or only_if_imbalanced and top <= IMBALANCE * least:
        return df
    sized = lookup_join(labelled, sizes, [label])
    rest = sized.filter(F.col("_n") == top).select(*df.columns)
    if least == top:
        return rest
    minority = sized.filter(F.col("_n") < top).select(*df.columns)
    numbered, _ = number_rows(minority, [label, *order], "_rank", total_order)
    plan = numbered.groupBy(label).agg(
        F.min("_rank").alias("_first"), F.count("*").alias("_n")
    )
    if mode == "exact":
        grown = _repeat_in_order(numbered, plan, label, top, least, copies_per_task)
    else:
        grown = _draw(numbered, plan, top, seed, copies_per_task)
    return union_all([rest, grown])
