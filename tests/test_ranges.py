"""Nested ranges, and filters of long lists."""

import random

import pytest
from pyspark.sql import functions as F

from flowlens.operators import enrich
from flowlens.plans import membership, nesting


def nested(rng, low, high, depth, found):
    """Ranges within ``low..high``, nested at random."""
    at = low
    while at <= high:
        end = min(high, at + rng.randint(0, max(1, (high - low) // 3)))
        if rng.random() < 0.7 and (at, end) != (low, high):
            found.append((at, end))
            if depth and end > at:
                nested(rng, at, end, depth - 1, found)
        at = end + 1 + rng.randint(0, 2)
    return found


def owner(ranges, point):
    holding = [(hi - lo, lo, hi) for lo, hi in ranges if lo <= point <= hi]
    return min(holding)[1:] if holding else None


@pytest.mark.parametrize(("seed", "chunk"), [(1, 1 << 18), (2, 7), (3, 2)])
def test_parts_of_nested_ranges(spark, seed, chunk):
    rng = random.Random(seed)
    ranges = list(dict.fromkeys([(0, 400), *nested(rng, 0, 400, 4, []), (500, 500), (600, 650), (600, 610), (640, 650)]))
    rng.shuffle(ranges)
    df = spark.createDataFrame([(lo, hi, f"{lo}-{hi}", "x") for lo, hi in ranges], "lo int, hi bigint, name string, lead string")
    found = nesting.disjoint(df.repartition(5), chunk)
    assert found.columns == df.columns
    parts = found.collect()
    for point in range(-1, 655):
        holding = [r.name for r in parts if r.lo <= point <= r.hi]
        expected = owner(ranges, point)
        assert holding == ([] if expected is None else [f"{expected[0]}-{expected[1]}"])


@pytest.mark.parametrize("bad", [[(1, 5), (3, 8)], [(1, 5), (1, 5)], [(5, 1)], [(0, 9), (2, 4), (4, 6)], [(1, None)]])
def test_other_overlaps_are_refused(spark, bad):
    with pytest.raises(ValueError, match="ranges"):
        nesting.disjoint(spark.createDataFrame(bad, "lo bigint, hi bigint"))


def test_nothing_to_make_disjoint(spark):
    assert nesting.disjoint(spark.createDataFrame([], "lo bigint, hi bigint, v string")).collect() == []


def test_the_most_specific_range_counts(spark, rows):
    ranges = spark.createDataFrame(
        [(0, 2**32 - 1, "world", "w", 0.0, 0.0), (167772160, 184549375, "ten", "t", 1.0, 1.0), (167772161, 167772161, "one", "o", 2.0, 2.0)],
        "lo bigint, hi bigint, country string, city string, latitude double, longitude double",
    )
    df = spark.createDataFrame([("10.0.0.1",), ("10.0.0.2",), ("9.9.9.9",), ("bad",), (None,)], "src_ip string")
    for bound in (1_000, 0):
        found = enrich.enrich_geo(df, ranges, broadcast_rows=bound, nested=True).select("src_ip", "country")
        assert {r.src_ip: r.country for r in found.collect()} == {
            "10.0.0.1": "one", "10.0.0.2": "ten", "9.9.9.9": "world", "bad": None, None: None,
        }
    with pytest.raises(ValueError, match="overlap"):
        enrich.enrich_geo(df, ranges)


def test_filter_keeps_every_member_and_few_others(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    words = membership.filter_words(20_000)
    table = membership.key_filter(keys, "key", words).cache()
    assert table.count() * membership.ROW_WORDS <= words and 8 * words <= 2 * 20_000 * 2
    assert membership.possible_members(keys, "key", table, words).count() == 20_000
    others = spark.range(20_000).select(F.concat(F.lit("o"), "id").alias("key"), F.lit(1).alias("_mask_of"))
    passed = membership.possible_members(others, "key", table, words)
    assert passed.columns == others.columns and passed.count() < 2_000


def test_filter_size_is_bounded():
    assert membership.filter_words(1) == membership.ROW_WORDS
    assert 8 * membership.filter_words(10**12) <= membership.MAX_BYTES
    assert membership.filter_words(10**6) * 64 >= 16 * 10**6


def test_a_small_filter_still_gives_right_flags(spark, monkeypatch, rows):
    monkeypatch.setattr(enrich, "filter_words", lambda n: membership.ROW_WORDS)
    df = spark.createDataFrame([(f"a{i}", i) for i in range(3_000)] + [(None, -1)], "src_ip string, i int")
    listed = spark.range(0, 60_000, 7).select(F.concat(F.lit("a"), "id").alias("ip"))
    flagged = enrich.flag_threats(df, listed, broadcast_rows=100)
    assert {r.i for r in flagged.where("is_malicious_ip").collect()} == set(range(0, 3_000, 7))
    assert flagged.count() == 3_001


def test_few_addresses_are_shuffled_to_a_long_list(spark):
    df = spark.range(50_000).select(F.concat(F.lit("a"), "id").alias("src_ip"))
    listed = spark.range(10_000).select(F.concat(F.lit("b"), "id").alias("src_ip"))
    words = membership.filter_words(listed.count())
    table = membership.key_filter(listed, "src_ip", words)
    assert membership.possible_members(df, "src_ip", table, words).count() < 5_000
    assert enrich.occurring(df, listed, "src_ip").count() == 0
    # The rows themselves only meet the addresses that occur, without a shuffle.
    flagged = enrich.flag_threats(df, listed.withColumnRenamed("src_ip", "ip"), broadcast_rows=1_000)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
