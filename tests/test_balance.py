from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowlens.operators import balance


def classes(spark, **sizes):
    rows = [(name, i) for name, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "label string, i int")


@pytest.mark.parametrize(
    ("sizes", "due"),
    [({"a": 9}, False), ({"a": 10, "b": 2}, False), ({"a": 11, "b": 2}, True), ({}, False)],
)
def test_class_balance(spark, sizes, due):
    found = balance.class_balance(classes(spark, **sizes), "label").first()
    assert (found.classes, found.oversample) == (len(sizes), due)


@pytest.mark.parametrize("sizes", [{"a": 9}, {"a": 10, "b": 2}])
def test_balanced_input_is_left_alone(spark, sizes):
    df = classes(spark, **sizes)
    assert balance.oversample(df, "label", order=["i"]) is df


def test_exact_oversampling_keeps_all_classes(spark):
    df = classes(spark, a=23, b=4, c=7)
    found = balance.oversample(df, "label", order=["i"], total_order=True)
    assert found.columns == df.columns
    got = Counter((r.label, r.i) for r in found.collect())
    expected = Counter()
    for name, n in {"a": 23, "b": 4, "c": 7}.items():
        for i in range(n):
            expected[(name, i)] = 23 // n + (1 if i < 23 % n else 0)
    assert got == expected


def test_many_copies_are_spread_over_tasks(spark, rows):
    df = classes(spark, a=100, b=2, c=7)
    whole = balance.oversample(df, "label", order=["i"], total_order=True)
    pieces = balance.oversample(df, "label", order=["i"], total_order=True, copies_per_task=4)
    assert rows(whole) == rows(pieces)
    drawn = balance.oversample(df, "label", "drawn", ["i"], total_order=True, copies_per_task=4)
    sizes = {r.label: r["count"] for r in drawn.groupBy("label").count().collect()}
    assert sizes == {"a": 100, "b": 100, "c": 100}
    assert rows(drawn) == rows(balance.oversample(df, "label", "drawn", ["i"], total_order=True))


def test_jobs_do_not_depend_on_the_number_of_classes(spark):
    jobs = []
    for n in (2, 12):
        df = classes(spark, a=100, **{f"c{i}": 3 for i in range(n)})
        spark.sparkContext.setJobGroup(f"draw{n}", "")
        balance.oversample(df, "label", "drawn", ["i"], total_order=True)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"draw{n}")))
    assert jobs[0] == jobs[1]


def test_missing_labels_are_no_class(spark):
    missing = spark.createDataFrame([(None, 1)], "label string, i int")
    df = classes(spark, a=10, b=8).union(missing)
    found = balance.class_balance(df, "label").first()
    assert (found.classes, found.smallest, found.oversample) == (2, 8, False)


def test_exact_oversampling_of_copies(spark):
    """Rows that tie in the order are still all repeated evenly."""
    df = classes(spark, a=12).union(spark.createDataFrame([("b", 1)] * 2, "label string, i int"))
    found = balance.oversample(df, "label", order=["i"])
    assert Counter(r.label for r in found.collect()) == {"a": 12, "b": 12}


def test_drawn_classes_have_the_size_of_the_largest(spark):
    df = classes(spark, a=3000, b=100, c=40)
    found = balance.oversample(df, "label", mode="drawn")
    sizes = {r.label: r["count"] for r in found.groupBy("label").count().collect()}
    assert sizes == {"a": 3000, "b": 3000, "c": 3000}
    times = [r["count"] for r in found.filter("label <> 'a'").groupBy("label", "i").count().collect()]
    assert len(times) > 130 and min(times) < 75 and max(times) < 150
    known = {(r.label, r.i) for r in df.collect()}
    assert {(r.label, r.i) for r in found.collect()} <= known


def test_rows_without_label_go(spark):
    df = classes(spark, a=20, b=2).union(spark.createDataFrame([(None, 1)], "label string, i int"))
    found = balance.oversample(df, "label", order=["i"])
    assert found.filter(F.col("label").isNull()).count() == 0 and found.count() == 40


def test_union_all_matches_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    assert rows(balance.union_all([a, a.select("s", "i"), a])) == [(1, "x")] * 3


def test_draws_are_not_broadcast(spark):
    """Few pieces become as many draws as the largest class has rows; Spark sees the pieces only."""
    df = classes(spark, a=50_000, b=100, c=40)
    found = balance.oversample(df, "label", "drawn", ["i"], total_order=True, copies_per_task=1000)
    assert found.count() == 150_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    (join,) = (line for line in plan.splitlines() if "Join [_rank" in line)
    assert "SortMergeJoin" in join
