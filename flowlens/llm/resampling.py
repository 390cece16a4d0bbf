"""Importance resampling of documents towards a target distribution of hashed word n-grams.

1. Each text becomes the array of the buckets of its features (runs of 1 to ``grams`` consecutive
   words), written once.
2. Feature counts per bucket of the corpus and of the target give every bucket a gain, the scaled
   logarithm of its likelihood ratio. A document's weight is the sum of the gains its array names; the
   gains are a list of ``buckets`` numbers, whatever the size of the corpus.
3. A weight plus fixed Gumbel noise of the id is the document's score: the highest scores are a draw
   without replacement in proportion to the likelihood ratio.
4. The draw takes the exact cutoff key by weighted median-of-medians selection. Every batch of a task
   names its median and size, a task the weighted median of its batches, the driver the weighted median
   of the tasks: at least an eighth of the remaining keys lies on either side of it, so a round discards
   a guaranteed part. Keys that remain are written again whenever they have halved, so all rounds
   together read a few times the keys. Below ``FEW`` keys the last ones are sorted on the driver.
5. Only the winners are sorted, by range partitions, and numbered.

Defined cases: a null text has no words, weight 0 and no chance of a draw; a null id counts as empty text
in the noise and comes after all ids in ties; rows with the same id are documents of their own, ties
among them go by their place in the written table; an empty target or corpus counts 0 in every
bucket; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.chunks import text_blocks
from flowlens.plans.ordering import number_rows
from flowlens.plans.staging import stage

BUCKETS = 10_000
GRAMS = 1
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
#: Keys that the driver sorts at the end of a selection.
FEW = 4_096
BLOCK_CHARS = 1_000_000
KNOWN_FEATURES = 400_000
_LAST = 2**63 - 1
_KEY = ["cost", "ord", "row"]


def _as_words() -> bytes:
    """Bytes of words, A-Z lower-cased; any other byte becomes a blank."""
    table = bytearray(b" " * 256)
    table[0x30:0x3A] = range(0x30, 0x3A)
    table[0x41:0x5B] = table[0x61:0x7B] = range(0x61, 0x7B)
    table[0x80:] = range(0x80, 0x100)
    return bytes(table)


_WORDS = _as_words()


def feature_buckets(docs: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``id``, ``n_words`` and the array ``found`` of the buckets of all features, of every row (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            sizes, arrays = [], []
            if len(known) > KNOWN_FEATURES:
                known = {}
            for text in texts:
                words = text.encode().translate(_WORDS).split()
                features = list(words)
                for n in range(2, grams + 1):
                    features += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
                for feature in set(features):
                    if feature not in known:
                        known[feature] = zlib.crc32(feature) % buckets
                sizes.append(len(words))
                arrays.append(np.fromiter(map(known.__getitem__, features), np.int32, len(features)))
            offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays))),
                ],
                ["id", "n_words", "found"],
            )

    return docs.select(F.col("id").cast("long").alias("id"), "text").mapInArrow(
        run, "id long, n_words long, found array<int>"
    )


def bucket_counts(arrays: DataFrame) -> DataFrame:
    """``bucket`` and its number ``n`` of features; at most one row per bucket."""
    return arrays.select(F.explode("found").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Scaled log-likelihood ratio of every bucket, from the ``bucket_counts`` of both sides."""
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(
        target.select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))
    )
    counted = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).toPandas()
    s, t = np.zeros(buckets), np.zeros(buckets)
    s[counted["bucket"]], t[counted["bucket"]] = counted["s"], counted["t"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(arrays: DataFrame, gain: np.ndarray) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight`` of every row of bucket arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(2)
            offsets = found.offsets.to_numpy().astype(np.int64)
            flat = found.values.to_numpy()[offsets[0] : offsets[-1]]
            summed = np.concatenate([[0], np.cumsum(gain[flat])])[offsets - offsets[0]]
            columns = [*batch.columns[:2], pa.array(np.diff(offsets)), pa.array(np.diff(summed))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    return arrays.select("id", "n_words", "found").mapInArrow(
        run, "id long, n_words long, n_features long, weight long"
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise, fixed by the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    uniform = (drawn.cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def weighted_median(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The least key whose size, with those of all keys below, is at least half of the total."""
    order = np.lexsort(keys.T[::-1])
    reached = np.cumsum(sizes[order])
    return keys[order[np.searchsorted(2 * reached, reached[-1])]]


def _medians(rows: DataFrame) -> DataFrame:
    """(n, key): size and pivot of every task that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes = [], []
        for batch in batches:
            if batch.num_rows:
                own = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(_KEY))])
                keys.append(weighted_median(own, np.ones(len(own), np.int64)))
                sizes.append(len(own))
        if keys:
            pivot = weighted_median(np.array(keys), np.array(sizes))
            columns = [pa.array([int(x)], pa.int64()) for x in (sum(sizes), *pivot)]
            yield pa.RecordBatch.from_arrays(columns, ["n", *_KEY])

    return rows.select(*_KEY).mapInArrow(run, "n long, cost long, ord long, row long")


def _compared(key: tuple[int, ...], equal: bool) -> Column:
    """Whether a row's key is below ``key`` (or equal to it)."""
    own = F.struct(*_KEY)
    other = F.struct(*[F.lit(int(x)).cast("long").alias(name) for x, name in zip(key, _KEY)])
    return own <= other if equal else own < other


def cutoff(keys: DataFrame, k: int, few: int = FEW) -> tuple[int, ...] | None:
    """The ``k``-th least of the distinct keys (cost, ord, row); None without any, the largest if there are fewer."""
    rest = keys.select(*_KEY)
    n = written = rest.count()
    k = min(k, n)
    if k <= 0:
        return None
    while n > few:
        found = np.array(_medians(rest).collect(), np.int64)
        pivot = tuple(int(x) for x in weighted_median(found[:, 1:], found[:, 0]))
        below = rest.where(_compared(pivot, equal=True)).count()
        if below == k:
            return pivot
        if below > k:
            rest, n = rest.where(_compared(pivot, equal=False)), below - 1
        else:
            rest, n, k = rest.where(~_compared(pivot, equal=True)), n - below, k - below
        if 2 * n <= written:
            rest, written = stage(rest, "remaining"), n
    return tuple(sorted(tuple(r) for r in rest.collect())[k - 1])


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    grams: int = GRAMS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    few: int = FEW,
) -> DataFrame:
    """Every document (doc_id, text) with ``n_features``, ``weight``, ``score`` and its ``rank`` in the draw.

    ``target`` has a column ``text``. ``percent`` of the documents with at least ``min_words`` words are
    drawn, rounded down; the others have no rank.
    """
    arrays = stage(feature_buckets(docs.select(F.col("doc_id").alias("id"), "text"), grams, buckets), "buckets")
    wanted = feature_buckets(target.select(F.lit(0).alias("id"), "text"), grams, buckets)
    weighed = weigh(arrays, gains(bucket_counts(arrays), bucket_counts(wanted), buckets))
    score = F.col("weight") + noise(F.col("id"), seed)
    scored = stage(
        weighed.withColumn("score", score)
        .withColumn("cost", -F.col("score"))
        .withColumn("ord", F.coalesce("id", F.lit(_LAST)))
        .withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    chosen = scored.where(F.col("n_words") >= min_words)
    last = cutoff(chosen, percent * chosen.count() // 100, few)
    columns = [F.col("id").alias("doc_id"), "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    within = (F.col("n_words") >= min_words) & _compared(last, equal=True)
    ranked, _ = number_rows(scored.where(within), _KEY, "rank", total_order=True)
    others = scored.where(~within).withColumn("rank", F.lit(None).cast("long"))
    return reduce(DataFrame.unionByName, [x.select(*columns, F.col("rank").cast("long")) for x in (ranked, others)])
