import random
from math import ceil

import pytest

from flowlens import Roles
from flowlens.operators import clean
from flowlens.plans import quantiles
from flowlens.plans.quantiles import sketched_quantiles

NAN = float("nan")


def test_drop_unlabelled(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (0, None)], "label int, attack_type string")
    assert rows(clean.drop_unlabelled(df, Roles.resolve(df))) == [(0, None), (1, "a")]
    assert rows(clean.drop_unlabelled(df, Roles(attack="attack_type"))) == [(1, "a"), (None, "b")]


def test_impute_mean(spark, rows):
    df = spark.createDataFrame(
        [(1, 1.0, None, None, 5), (2, NAN, None, None, None), (4, 2.0, None, None, 1), (None, None, None, 7, None)],
        "i int, d double, empty double, big long, label int",
    )
    found = rows(clean.impute_mean(df))
    assert found == sorted(
        [(1, 1.0, None, None, 5), (2, 1.5, None, None, None), (4, 2.0, None, None, 1),
         (2, 1.5, None, 7, None)], key=repr
    )
    assert clean.impute_mean(df).dtypes == df.dtypes


def test_impute_mean_truncates_negative_means(spark, rows):
    df = spark.createDataFrame([(-1,), (-2,), (-4,), (None,)], "i int")
    assert rows(clean.impute_mean(df)) == [(-1,), (-2,), (-2,), (-4,)]


def test_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 101)], "x double")
    assert clean.quantiles(df, "x", [0.25, 0.95], 0) == [25.0, 95.0]
    assert abs(clean.quantiles(df, "x", [0.5])[0] - 50) <= 2


def test_iqr_filter_keeps_values_on_the_bounds(spark, rows):
    # Quartiles 2 and 4, so the bounds are -1 and 7.
    values = [-1.0, -1.1, 2.0, 2.0, 3.0, 3.0, 4.0, 4.0, 7.0, 7.1, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert clean.quantiles(df, "x", [0.25, 0.75], 0) == [2.0, 4.0]
    kept = {v for (v,) in rows(clean.iqr_filter(df, "x", rel_error=0))}
    assert kept == {-1.0, 2.0, 3.0, 4.0, 7.0}


@pytest.mark.parametrize("rel_error", [0, 0.01])
def test_iqr_filter_of_nothing(spark, rel_error):
    df = spark.createDataFrame([(None,)], "x double")
    assert clean.iqr_filter(df, "x", rel_error=rel_error).count() == 0


def test_remove_outliers_goes_column_by_column(spark):
    """The second filter sees the quartiles of what the first one left."""
    data = [(10, 10, 1.0)] * 8 + [(1000, 500, 1.0)] * 2 + [(10, 12, 1.0), (10, 11, 1.0)]
    df = spark.createDataFrame(data, "sbytes int, dbytes int, dur double")
    roles = Roles.resolve(df)

    def quartile(rows, i, p):
        ordered = sorted(r[i] for r in rows)
        return ordered[ceil(p * len(ordered)) - 1]

    left = data
    for i in range(3):
        q1, q3 = quartile(left, i, 0.25), quartile(left, i, 0.75)
        reach = 1.5 * (q3 - q1)
        left = [r for r in left if q1 - reach <= r[i] <= q3 + reach]
    found = clean.remove_outliers(df, roles, rel_error=0)
    assert sorted(tuple(r) for r in found.collect()) == sorted(left)
    assert clean.remove_outliers(df, Roles(duration="dur"), rel_error=0).count() == 12


def rank_error(values, found, p):
    low, high = sum(v < found for v in values) / len(values), sum(v <= found for v in values) / len(values)
    return max(0.0, low - p, p - high)


def test_sketched_quantiles_measure_their_error(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 50), rng.lognormvariate(0, 3), None, NAN if i % 7 == 0 else 1.5) for i in range(20_000)]
    df = spark.createDataFrame(rows, "i int, d double, nothing bigint, n double").repartition(9)
    ps = [0.01, 0.25, 0.5, 0.99]
    found = sketched_quantiles(df, {c: ps for c in df.columns}, 0.01)
    assert found["nothing"] == []
    assert {q.value for q in found["n"]} == {1.5}
    for k, name in enumerate(("i", "d")):
        for p, q in zip(ps, found[name]):
            assert q.error <= 0.01
            assert q.error == pytest.approx(rank_error([r[k] for r in rows], q.value, p))


def test_sketches_grow_until_the_error_holds(spark, monkeypatch):
    df = spark.range(30_000).selectExpr("CAST(id AS double) AS x")
    sizes = []
    build = quantiles._sketched
    monkeypatch.setattr(quantiles, "sketch_size", lambda e: 8)
    monkeypatch.setattr(quantiles, "_sketched", lambda *a: sizes.append(a[-1]) or build(*a))
    (found,) = sketched_quantiles(df, {"x": [0.5]}, 0.0005)["x"]
    assert found.error <= 0.0005 and len(sizes) > 1 and sizes == sorted(sizes)


def test_sketched_quantiles_take_two_passes_for_all_columns(spark):
    df = spark.range(100).selectExpr("id AS a", "id * 2 AS b", "CAST(id AS double) AS c")
    context = spark.sparkContext
    context.setJobGroup("sketches", "sketches")
    sketched_quantiles(df, {c: [0.25, 0.75] for c in df.columns}, 0.05)
    assert len(context.statusTracker().getJobIdsForGroup("sketches")) <= 4
    context.setJobGroup("", "")
