"""Sums that do not depend on the order of the rows."""

import random
import statistics
from fractions import Fraction
from math import inf, isnan, nan

import pytest
from pyspark.sql import functions as F

from flowlens.operators import behavior, profile
from flowlens.plans import exact
from flowlens.roles import Roles


def numbers(rng, n):
    picks = [
        lambda: rng.uniform(-1, 1),
        lambda: rng.choice([0.1, 0.05, -0.07, 1e-3]),
        lambda: rng.uniform(-1e9, 1e9),
        lambda: rng.uniform(1e15, 1e16),
        lambda: -rng.uniform(1e15, 1e16),
        lambda: rng.choice([2.0**22, 2.0**44, -(2.0**66), 0.0, -0.0, 1e18]),
    ]
    return [rng.choice(picks)() for _ in range(n)]


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def moments_of(df):
    return exact.moments(df, exact.ranges(df, ["x"]))["x"]


def truth(values):
    values = [Fraction(v) for v in values if v is not None]
    return float(sum(values) / len(values)), statistics.stdev(values)


@pytest.mark.parametrize("seed", range(3))
def test_totals_of_doubles_are_exact(spark, seed):
    values = numbers(random.Random(seed), 400)
    df = column(spark, values)
    mean, std = moments_of(df)
    assert mean == truth(values)[0] and std == pytest.approx(truth(values)[1], rel=1e-14)
    total = float(sum(map(Fraction, values)))
    found = df.agg(
        exact.exact_sum("x", "double").alias("fixed"),
        exact.scaled_sum("x", "double", exact.ranges(df, ["x"])["x"]).alias("scaled"),
        exact.mean_of(exact.exact_sum("x", "double"), "x").alias("mean"),
    ).first()
    assert found.fixed == pytest.approx(total, rel=1e-15) and found.mean == found.fixed / len(values)
    assert found.scaled == pytest.approx(total, rel=1e-15)


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("int", [2**31 - 1, -(2**31), 5, -1, 0, None]),
        ("bigint", [2**59, -(2**59), 2**63 - 1, 2**40 + 3, -7, None]),
        ("bigint", [2**63 - 1, -(2**63)]),
        ("bigint", [1_700_000_000_000_000 + i for i in range(50)]),
        ("double", [1e-300, 3e-300, 2e-300]),
        ("double", [1e300, -3e299, 5.0]),
        ("float", [0.1, 0.2, 2.5]),
    ],
)
def test_moments_of_any_range(spark, kind, values):
    df = column(spark, values, kind)
    known = [r.x for r in df.dropna().collect()]
    mean, std = moments_of(df)
    assert mean == truth(known)[0]
    if max(map(abs, known)) < 1e200 and max(map(abs, known)) > 1e-200:
        assert std == pytest.approx(truth(known)[1], rel=1e-15)
    if kind in exact.WHOLE_TYPES:
        assert df.agg(exact.exact_sum("x", kind)).first()[0] == float(sum(known))


def test_small_negative_totals_keep_their_digits(spark):
    df = column(spark, [-0.05, 1e6, -1e6])
    assert df.agg(exact.exact_sum("x", "double")).first()[0] == -0.05
    assert moments_of(df)[0] == -0.05 / 3


def test_numbers_that_are_not_finite(spark):
    def both(values):
        df = column(spark, values)
        found = df.agg(exact.exact_sum("x", "double")).first()[0]
        row = profile.numeric_profile(df).first()
        return found, row["mean"], row["std"]

    assert all(isnan(x) for x in both([1.0, nan]))
    assert both([1.0, inf])[:2] == (inf, inf) and isnan(both([1.0, inf])[2])
    assert isnan(both([-inf, inf])[0])
    assert both([None, None]) == (None, None, None)
    assert both([4.5]) == (4.5, 4.5, None)


def test_order_and_partitions_leave_the_bits_alone(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice([0.05, 0.1, 0.07]), rng.uniform(-1e6, 1e6), rng.randint(-(10**15), 10**15), rng.randint(0, 9), rng.choice("ab"))
        for _ in range(3000)
    ]
    schema = "rate double, dur double, sbytes bigint, n int, srcip string"
    found = []
    for parts in (1, 7, 64):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, schema).repartition(parts)
        roles = Roles(src="srcip", dst="n", src_bytes="sbytes", dst_bytes="sbytes", duration="rate")
        profiled = sorted(map(tuple, profile.numeric_profile(df).collect()))
        pairs = sorted(map(tuple, behavior.top_pairs(df, roles, 30).collect()))
        paired = behavior.top_pairs(behavior.host_pairs(df, roles), roles, 30, paired=True)
        assert sorted(map(tuple, paired.collect())) == pairs
        found.append((profiled, pairs))
    assert found[0] == found[1] == found[2]


def test_deviation_of_close_numbers_far_from_zero(spark):
    for kind, values in (
        ("bigint", [1_700_000_000_000_000 + i for i in range(100)]),
        ("double", [1e9 + i / 8 for i in range(100)]),
    ):
        row = profile.numeric_profile(column(spark, values, kind)).first()
        assert row["std"] == pytest.approx(statistics.stdev(map(Fraction, values)), rel=1e-15)
        assert row["mean"] == float(sum(map(Fraction, values)) / 100)
