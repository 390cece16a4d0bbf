import pytest

from flowlens import Roles
from flowlens.operators import anomaly


@pytest.fixture
def flow(spark):
    near = [(i, 100 + i % 7, 10 + i % 3, 1.0 + i % 2) for i in range(60)]
    far = [(100 + i, 90000 + i, 80000, 50.0) for i in range(5)]
    return spark.createDataFrame(near + far, "i int, sbytes int, dbytes int, dur double")


@pytest.fixture
def roles(flow):
    return Roles.resolve(flow)


def test_feature_vector(spark, flow, roles):
    found = anomaly.feature_vector(flow, roles).filter("i = 100").first()
    assert list(found.features) == [90000.0, 80000.0, 50.0]
    counted = flow.selectExpr("*", "i AS count", "i AS srv_count")
    assert anomaly.feature_columns(Roles.resolve(counted))[3:] == ["count", "srv_count"]
    with pytest.raises(ValueError, match="3 feature columns"):
        anomaly.feature_columns(Roles(src_bytes="sbytes", duration="dur"))


@pytest.mark.parametrize("scale", [False, True])
def test_minority_cluster(flow, roles, scale):
    clustered = anomaly.cluster(flow, roles, scale=scale)
    assert clustered.columns == [*flow.columns, "prediction"] and clustered.count() == 65
    profile = anomaly.cluster_profile(clustered, roles).collect()
    assert sorted(r["count"] for r in profile) == [5, 60]
    assert sorted(r.i for r in anomaly.anomalies(clustered, roles).collect()) == list(range(100, 105))
    report = anomaly.anomaly_report(clustered, roles).collect()
    assert [tuple(r) for r in report] == [(5, 5 / 65, 90002.0, 80000.0, 50.0)]


def test_one_cluster_in_use_means_no_anomaly(flow, roles):
    one = flow.selectExpr("*", "0 AS prediction")
    assert anomaly.anomalies(one, roles).count() == 0
    assert anomaly.anomaly_report(one, roles).count() == 0


def test_tie_goes_to_the_lower_cluster(flow, roles):
    halves = flow.filter("i < 60").selectExpr("*", "i % 2 AS prediction")
    assert {r.prediction for r in anomaly.anomalies(halves, roles).collect()} == {0}


def test_training_tasks_follow_the_distinct_rows(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "ROWS_PER_PARTITION", 50)
    counted = spark.range(601).selectExpr("id AS a", "IF(id < 1, NULL, id) AS b", "2.0D AS _weight")
    placed = anomaly._placed(counted, ["a", "b"], 2)
    assert placed.rdd.getNumPartitions() == 13 and placed.count() == 601


@pytest.mark.parametrize("scale", [False, True])
def test_weights_count_like_rows(spark, scale):
    """Many copies of one row pull the centres as the rows themselves would."""
    rows = [(float(x), 0.0, 1.0) for x in [0] * 300 + list(range(1, 40)) + [100] * 3 + [130]]
    df = spark.createDataFrame(rows, "sbytes double, dbytes double, dur double")
    roles = Roles.resolve(df)
    model = anomaly.fit_clusters(df, roles, scale=scale)
    clustered = anomaly.cluster(df, roles, scale=scale)
    # The centres are the means over all rows, not over the distinct ones.
    if not scale:
        means = sorted(r[0] for r in clustered.groupBy("prediction").avg("sbytes").select("avg(sbytes)").collect())
        assert sorted(c[0] for c in model.stages[-1].clusterCenters()) == pytest.approx(means)
    sizes = {r.prediction: r["count"] for r in clustered.groupBy("prediction").count().collect()}
    assert sizes[0] > sizes[1]


def test_clusters_do_not_depend_on_the_layout(flow, roles):
    found = {
        tuple(sorted((r.i, r.prediction) for r in anomaly.cluster(flow.repartition(n), roles).collect()))
        for n in (1, 5, 40)
    }
    assert len(found) == 1
