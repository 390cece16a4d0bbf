import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [zlib.crc32(w.encode()) % 10_000 for w in WORD.findall(lowered)]


def brute(pairs, target):
    arrays = [buckets_of(t) for _, t in pairs]
    s, t = Counter(b for a in arrays for b in a), Counter(b for x in target for b in buckets_of(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))
    )
    found = []
    for (i, _), a in zip(pairs, arrays):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, a))
        found.append([i, len(a), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((r for r in found if r[1] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for rank, row in enumerate(order[: 10 * len(order) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, found), key=repr)


def rows(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def corpus(rng, n):
    return [(i, " ".join(f"Word{rng.randint(0, 400)}" for _ in range(rng.randint(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("few", [1, 7, 4_096])
def test_draw_against_brute_force(spark, docs_of, few):
    rng = random.Random(few)
    pairs, target = corpus(rng, 300), ["word1 word2, WORD3-word4", None, ""]
    items = spark.createDataFrame([(t,) for t in target], "text string")
    assert rows(resampling.resample(docs_of(pairs).repartition(5), items, few=few)) == brute(pairs, target)


def test_odd_rows(spark, docs_of, odd):
    pairs = [*odd, *corpus(random.Random(3), 40), (None, "a " * 30), (50, "ünï_ünï ÀB 1a" * 20)]
    items = spark.createDataFrame([("ünï word",)], "text string")
    assert rows(resampling.resample(docs_of(pairs), items)) == brute(pairs, ["ünï word"])


def test_empty_tables(spark, docs_of):
    nothing = spark.createDataFrame([], "text string")
    assert resampling.resample(docs_of([]), nothing).collect() == []
    pairs = corpus(random.Random(4), 30)
    assert rows(resampling.resample(docs_of(pairs), nothing)) == brute(pairs, [])


def test_repeated_rows_are_drawn_one_by_one(spark, docs_of):
    pairs = [(7, "a b " * 20)] * 50
    found = resampling.resample(docs_of(pairs), spark.createDataFrame([("a",)], "text string"))
    assert sorted(r["rank"] for r in found.collect() if r["rank"]) == [1, 2, 3, 4, 5]


def test_pairs_of_words_are_features(spark):
    one = spark.createDataFrame([(1, "A b a")], "id long, text string")
    found = resampling.feature_buckets(one, grams=2).first()
    assert found["n_words"] == 3
    assert found["found"] == [zlib.crc32(f) % 10_000 for f in (b"a", b"b", b"a", b"a b", b"b a")]


@pytest.mark.parametrize("shape", ["ties", "sorted", "random"])
def test_cutoff_is_the_exact_key(spark, shape):
    rng = random.Random(1)
    cost = {"ties": lambda i: i % 3, "sorted": lambda i: i, "random": lambda i: rng.randint(-(10**6), 10**6)}[shape]
    keys = [(cost(i), i // 2, i) for i in range(500)]
    rows_in = spark.createDataFrame(keys, "cost long, ord long, row long").repartition(7, F.col("row") % 3)
    for k in (1, 2, 250, 499, 500, 900):
        assert resampling.cutoff(rows_in, k, few=1) == sorted(keys)[min(k, 500) - 1]
    assert resampling.cutoff(rows_in, 0) is None


def test_weighted_median_discards_a_part_on_both_sides():
    rng = np.random.default_rng(1)
    for _ in range(50):
        groups = [rng.integers(0, 1000, (rng.integers(1, 60), 3)) for _ in range(rng.integers(1, 20))]
        ones = [np.ones(len(g), np.int64) for g in groups]
        pivots = np.array([resampling.weighted_median(g, o) for g, o in zip(groups, ones)])
        pivot = tuple(resampling.weighted_median(pivots, np.array([len(g) for g in groups])))
        keys = [tuple(k) for g in groups for k in g]
        assert 4 * sum(k <= pivot for k in keys) >= len(keys)
        assert 4 * sum(k >= pivot for k in keys) >= len(keys)
