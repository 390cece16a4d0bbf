"""Spelling variants grouped by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one into the other; that is so
if their common prefix and their common suffix together reach the length of the longer one minus one.

1. Words are counted over all texts.
2. *Windows.* The length of the common prefix is the place of the edit in the longer word. For a window
   of places ``[low, high)``, near words agree on the first ``low`` code points and on the last
   ``length - high`` ones, where ``length`` is that of the longer word; words that agree on both form a
   group. Each word stands in the groups of two windows (its first and second half), for the longer word
   and for the shorter one, so every near pair meets in exactly one group.
3. *Refinement.* A group above ``GROUP`` words (or ``GROUP_CHARS`` code points) is dealt anew with its
   window halved, until it fits. A window of one place needs no bound: its words differ in that one
   letter only, so there are no more than letters, and one shorter word.
4. *Tiles.* The words of a group become two padded code-point matrices, aligned at the left and at the
   right. Pairs of blocks are compared at once: common prefixes from the first, common suffixes from the
   second.
5. Each group reports the number of near words and the best one per word; the sums and the best over all
   groups are exact, as no pair occurs twice. No pairs are written.
6. Roots come from pointer doubling: counts grow at least tenfold along a chain of forms, so a few rounds
   are enough.

Counting is pre-aggregated, and groups are bounded, so that no frequent word or beginning holds up a
task. Bounds change the plan only, never the result.

Defined cases: a null text has no words; a null id counts as empty text in the hash; repeated rows count
each; words of any length are compared whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.text import lower_ascii
from flowlens.plans.skew import lookup_join
from flowlens.plans.staging import stage

MIN_CHARS, MIN_COUNT = 7, 2
#: A form is this many times as frequent as its variant.
RATIO = 10
#: One in so many occurrences loses a code point.
ERRORS = 31
#: Most words and code points of a group whose window can still be halved.
GROUP, GROUP_CHARS = 512, 1 << 22
#: Most words of a block, and most code points of a pair of blocks.
BLOCK, TILE_CHARS = 128, 1 << 22
_RUNS = "[^A-Za-zÀ-ÿ]+"
_GROUPED = ["length", "low", "high", "word", "n"]


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``word`` of every occurrence; one in ``ERRORS``, by the hash of id and run, has lost a code point."""
    runs = F.filter(F.split(F.col("text"), _RUNS), lambda r: F.length(r) >= min_chars)
    found = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = found.withColumn("h", F.crc32(named.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % ERRORS == 0, shorter).otherwise(F.col("run")).alias("word")
    return hashed.select(word).where(F.length("word") >= min_chars)


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and its number ``n`` of occurrences, for words with at least ``min_count``."""
    counted = occurrences(docs, min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _window(low: Column, high: Column, length: Column) -> Column:
    """A window of edit places with the group of ``word`` in it."""
    word = F.col("word")
    tail = length - high
    ends = F.substring(word, F.length("word") - tail + 1, tail)
    group = F.xxhash64(length, low, high, F.substring(word, F.lit(1), low), ends)
    return F.struct(group.alias("grp"), length.alias("length"), low.alias("low"), high.alias("high"))


def _in_windows(rows: DataFrame, windows: Column) -> DataFrame:
    return rows.select("word", "n", F.explode(windows).alias("at")).select("at.grp", *[f"at.{c}" for c in _GROUPED[:3]], "word", "n")


def _first_windows(words: DataFrame) -> DataFrame:
    halves = []
    for more in (0, 1):  # the word itself is the longer one, or another one is
        length = F.length("word") + more
        middle = F.floor(length / 2).cast("int")
        halves += [_window(F.lit(0), middle, length), _window(middle, length, length)]
    return _in_windows(words, F.array(*halves))


def _halved(rows: DataFrame) -> DataFrame:
    low, high, length = F.col("low"), F.col("high"), F.col("length")
    middle = F.floor((low + high) / 2).cast("int")
    return _in_windows(rows, F.array(_window(low, middle, length), _window(middle, high, length)))


def window_groups(words: DataFrame, group: int = GROUP, group_chars: int = GROUP_CHARS) -> DataFrame:
    """Rows (grp, length, low, high, word, n) of groups that are small, or have a window of one place."""
    rows, found = stage(_first_windows(words), "windows"), None
    while True:
        # A group of one word has nothing to compare, but is not worth a join of its own.
        sizes = rows.where("high - low > 1").groupBy("grp").agg(
            F.count("*").alias("members"), F.sum(F.length("word")).alias("chars")
        )
        large = stage(sizes.where((F.col("members") > group) | (F.col("chars") > group_chars)), "large")
        if large.isEmpty():
            return rows if found is None else found.unionByName(rows)
        sized = stage(lookup_join(rows, large.select("grp", "members"), ["grp"]), "sized")
        whole = sized.where("members IS NULL OR high - low = 1").drop("members")
        found = whole if found is None else found.unionByName(whole)
        rows = stage(_halved(sized.where("members IS NOT NULL AND high - low > 1")), "windows")


def padded(words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words (latin letters, so one byte each) in matrices aligned at the left and right."""
    left = np.array([w.encode("latin-1") for w in words], f"S{length}").view(np.uint8).reshape(len(words), length)
    right = np.array([w.encode("latin-1").rjust(length, b"\0") for w in words], f"S{length}")
    return left, right.view(np.uint8).reshape(len(words), length)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading columns in which every row of ``a`` equals every row of ``b``; no two rows are equal."""
    return (a[:, None, :] != b[None, :, :]).argmax(axis=2)


def near_in_group(words: list[str], length: int, low: int, high: int, block: int = BLOCK) -> Iterator[tuple]:
    """Positions (i, j) of near pairs whose longer word has ``length`` and whose edit is in the window."""
    left, right = padded(words, length)
    short = np.array([len(w) < length for w in words])
    size = max(1, min(block, int((TILE_CHARS / length) ** 0.5)))
    for top in range(0, len(words), size):
        rows = slice(top, top + size)
        for start in range(top, len(words), size):
            cols = slice(start, start + size)
            prefix = _shared(left[rows], left[cols])
            suffix = _shared(right[rows, ::-1], right[cols, ::-1])
            near = (prefix + suffix >= length - 1) & (prefix >= low) & (prefix < high)
            near &= ~(short[rows, None] & short[None, cols])
            i, j = np.nonzero(near)
            later = j + start > i + top
            yield from zip((i[later] + top).tolist(), (j[later] + start).tolist())


def _group_reports(words: list[str], counts: list[int], length: int, low: int, high: int) -> Iterator[tuple]:
    """(word, near, cost, best): number of near words, the best one and its negative count."""
    near: dict[int, int] = {}
    best: dict[int, tuple[int, str]] = {}
    for pair in near_in_group(words, length, low, high):
        for own, other in (pair, pair[::-1]):
            near[own] = near.get(own, 0) + 1
            key = (-counts[other], words[other])
            if own not in best or key < best[own]:
                best[own] = key
    for own, number in near.items():
        yield words[own], number, *best[own]


def near_words(groups: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and, as ``best``, the smallest (negative count, word) of its near words."""
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    names = ["word", "near", "cost", "other"]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, words, counts, found = None, [], [], []
        for rows in batches:
            columns = [rows.column(i).to_pylist() for i in range(6)]
            for grp, length, low, high, word, n in zip(*columns):
                if (grp, length, low, high) != current:
                    if len(words) > 1:
                        found += _group_reports(words, counts, *current[1:])
                    current, words, counts = (grp, length, low, high), [], []
                words.append(word)
                counts.append(n)
            if len(found) >= 10_000:
                yield batch(found)
                found = []
        if len(words) > 1:
            found += _group_reports(words, counts, *current[1:])
        if found:
            yield batch(found)

    order = ["grp", *_GROUPED[:3]]
    placed = groups.select("grp", *_GROUPED).repartition("grp").sortWithinPartitions(*order)
    reports = placed.mapInArrow(run, "word string, near long, cost long, other string")
    best = F.min(F.struct("cost", "other")).alias("best")
    return reports.groupBy("word").agg(F.sum("near").alias("n_near"), best)


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and the last of its chain of forms as ``root``, for every word (word, form) with a form."""
    chain = stage(forms.select("word", F.col("form").alias("root")), "chain")
    while True:
        further = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stage(chain.join(further, "root", "left"), "chain")
        chain = longer.select("word", F.coalesce("next", "root").alias("root"))
        if longer.where("next IS NOT NULL").isEmpty():
            return chain


def group_variants(docs: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """Every word with ``n``, ``n_near``, its ``form`` with ``form_n``, and its ``root``."""
    words = stage(count_words(docs.select("doc_id", "text")), "words")
    near = near_words(window_groups(words, group))
    frequent = -F.col("best.cost") >= ratio * F.col("n")
    found = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("best.other")).alias("form"),
            F.when(frequent, -F.col("best.cost")).alias("form_n"),
        ),
        "variants",
    )
    last = roots(found.where("form IS NOT NULL"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
