import random
import statistics
from math import ceil

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.plans.ordering import FRAME, HOME, number_rows, with_frames
from flowlens.plans.quantiles import exact_quantiles
from flowlens.plans.skew import keys_above, lookup_join, split_hot
from flowlens.plans.staging import stage, work_dir


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def by_rank(values, p):
    ordered = sorted(v for v in values if v is not None and v == v)
    return ordered[max(1, ceil(round(p * 100) * len(ordered) / 100)) - 1]


RANDOM = random.Random(5)
SHAPES = {
    "uniform": [RANDOM.uniform(-5, 5) for _ in range(3000)],
    "heavy tail": [RANDOM.lognormvariate(0, 9) for _ in range(3000)],
    "one value holds a third": [7.0] * 1000 + [RANDOM.uniform(0, 20) for _ in range(2000)],
    "one value": [3.0] * 50,
    "tiny and huge": [1e-300, -1e300, 0.0, -0.0, 1e300, 5e-324] * 5,
    "close together": [1e9 + i * 1e-6 for i in range(2000)],
    "null and nan": [1.0, None, float("nan"), 2.0, 3.0, None],
    "single": [4.0],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_exact_quantiles(spark, shape):
    ps = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    found = exact_quantiles(numbers(spark, SHAPES[shape]), "x", ps)
    assert found == [by_rank(SHAPES[shape], p) for p in ps]


def test_exact_quantiles_of_nothing(spark):
    assert exact_quantiles(numbers(spark, [None]), "x", [0.5]) == []


def test_number_rows_over_many_partitions(spark):
    values = [RANDOM.randrange(10**6) for _ in range(5000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long")
    numbered, n = number_rows(df.repartition(7), ["v", "i"], total_order=True)
    assert n == 5000
    got = [(r.v, r.i) for r in numbered.orderBy("row_index").collect()]
    assert got == sorted((v, i) for i, v in enumerate(values))
    assert numbered.agg(F.min("row_index"), F.max("row_index")).first() == (1, 5000)


def test_number_rows_splits_ties(spark):
    df = spark.range(0, 4000, 1, 4).select(F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered, _ = number_rows(df, ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.row_index for r in numbered.collect()) == list(range(1, 4001))
    sizes = [r["count"] for r in numbered.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 4000 * 0.6


def test_number_rows_without_order(spark):
    numbered, n = number_rows(spark.range(0, 100, 1, 5))
    assert n == 100 and sorted(r.row_index for r in numbered.collect()) == list(range(1, 101))


def test_number_rows_of_nothing(spark):
    numbered, n = number_rows(spark.range(0), ["id"], total_order=True)
    assert n == 0 and numbered.count() == 0


@pytest.mark.parametrize(("size", "before", "after"), [(8, 3, 0), (8, 0, 8), (5, 5, 5), (100, 4, 4)])
def test_frames_agree_with_one_window(spark, size, before, after):
    df = spark.range(1, 64).select(F.col("id").alias("i"), (F.col("id") * 7 % 31).alias("v"))
    framed = with_frames(df, "i", before, after, size)
    rows = Window.partitionBy(FRAME).orderBy("i").rowsBetween(-before, after)
    found = framed.withColumn("s", F.sum("v").over(rows)).filter(HOME).orderBy("i").collect()
    values = [i * 7 % 31 for i in range(1, 64)]
    assert [r.s for r in found] == [
        sum(values[max(0, k - before) : k + after + 1]) for k in range(63)
    ]


def test_frames_must_be_long_enough(spark):
    with pytest.raises(ValueError, match="frame"):
        with_frames(spark.range(3), "id", 5, 0, 4)


@pytest.fixture
def skewed(spark):
    keys = ["hot"] * 60 + [None] * 40 + [f"k{i}" for i in range(50)]
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")


def test_keys_above(spark, skewed, rows):
    assert rows(keys_above(skewed, ["k"], 30)) == [("hot",), (None,)]
    assert keys_above(skewed, ["k"], 60) is None


def test_split_hot_keeps_every_row(spark, skewed):
    hot, rest = split_hot(skewed, keys_above(skewed, ["k"], 30), ["k"])
    assert (hot.count(), rest.count()) == (100, 50)


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_lookup_join_small_or_large(spark, skewed, rows, broadcast_rows):
    dim = spark.createDataFrame([("hot", 1), ("k3", 2), ("gone", 3)], "k string, v int")
    joined = lookup_join(skewed, dim, ["k"], broadcast_rows)
    assert joined.columns == ["k", "i", "v"]
    expected = {"hot": 1, "k3": 2}
    assert rows(joined) == sorted(
        ((r.k, r.i, expected.get(r.k)) for r in skewed.collect()), key=repr
    )


def test_large_lookup_does_not_broadcast_the_table(spark, skewed):
    dim = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = lookup_join(skewed, dim, ["k"], broadcast_rows=100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan


def test_stage_uses_the_named_folder(spark, tmp_path):
    assert work_dir(spark) == work_dir(spark)
    staged = stage(spark.range(3), "x")
    assert staged.inputFiles()[0].removeprefix("file://").startswith(work_dir(spark))
    assert staged.count() == 3


def test_work_dir_refuses_a_local_folder_on_a_cluster():
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return self.value or default

    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        conf, sparkContext = Conf(None), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Session())
    Session.conf = Conf("hdfs://shared/dir/")
    assert work_dir(Session()) == "hdfs://shared/dir"


def test_rank_definition():
    assert statistics.median_low([1, 2, 3, 4]) == by_rank([1, 2, 3, 4], 0.5)
