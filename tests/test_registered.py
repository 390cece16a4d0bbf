import os

import pytest

import __spark_entry__ as registered
from checks.compare import difference, duck
from checks.oracles import ORACLES
from checks.tables import FLOW, flows
from flowlens.operators import anomaly

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_every_query_is_checked_or_known_not_to_be():
    unchecked = set(registered.queries()) - set(registered.oracle_sql())
    unchecked = {n for n in unchecked if n != "pipeline" and not n.startswith("op")}
    assert unchecked == {"score_stream"}
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() == 10


def test_cluster_queries_are_consistent(spark):
    found = registered.queries()
    profile = found["cluster_profile"](spark, SF_DIR).collect()
    total = flows(spark, SF_DIR).count()
    assert sum(r["count"] for r in profile) == total
    report = found["anomaly_report"](spark, SF_DIR).first()
    smallest = min(r["count"] for r in profile)
    assert report.anomaly_count == smallest and report.anomaly_ratio == smallest / total
    assert found["anomalies"](spark, SF_DIR).count() == smallest
    assert anomaly.feature_columns(FLOW)[:3] == ["src_bytes", "dst_bytes", "duration"]


def test_scored_stream_has_every_closed_window(spark):
    found = registered.queries()
    scored = found["score_stream"](spark, SF_DIR)
    assert scored.count() == found["windowed_traffic"](spark, SF_DIR).count()
    assert {r.prediction for r in scored.select("prediction").distinct().collect()} == {0, 1}


def test_sketched_quartiles_join_the_flows_once(spark, monkeypatch):
    from checks import queries

    read, sketched = [], queries.sketched_quantiles

    def recorded(df, *args):
        read.extend(df.inputFiles())
        return sketched(df, *args)

    monkeypatch.setattr(queries, "sketched_quantiles", recorded)
    assert all(r.near for r in queries.iqr_filter_sketched(spark, SF_DIR).collect())
    assert read and not any("lineitem" in name for name in read)
