import csv
import json
from pathlib import Path

import pytest

from flowlens import Roles
from flowlens.operators import anomaly, behavior, distribution, prepare, profile, report
from flowlens.sinks import publish_reports, read_reports, write_reports
from flowlens.sources import default_taxonomy


@pytest.fixture(scope="module")
def flow(spark):
    near = [
        (f"10.0.0.{i % 4}", f"10.0.1.{i % 3}", 1024 + i, 80, "tcp" if i % 3 else "udp", "http",
         100 + i % 7, 10, 1.0, 1700000000 + i * 600, None, 0)
        for i in range(80)
    ]
    far = [
        ("10.0.0.9", "10.0.1.1", 5, 22, "tcp", "ssh", 90000 + i, 80000, 50.0, 1700000000, "DoS", 1)
        for i in range(6)
    ]
    return spark.createDataFrame(
        near + far,
        "srcip string, dstip string, sport int, dsport int, proto string, service string, "
        "sbytes int, dbytes int, dur double, stime long, attack_category string, label int",
    )


@pytest.fixture(scope="module")
def roles(flow):
    return Roles.resolve(flow)


@pytest.fixture(scope="module")
def reports(flow, roles):
    found = report.analyze(flow, roles, order=["dur", "sport"], rel_error=0)
    yield found
    found.release()


def test_every_report_equals_its_operator(flow, roles, reports, rows):
    clustered = anomaly.cluster(flow, roles)
    alone = {
        "overview": profile.overview(flow),
        "numeric_profile": profile.numeric_profile(flow),
        "categorical_top": profile.categorical_top(flow),
        "missing_counts": profile.missing_counts(flow),
        "data_stats": profile.data_stats(flow, roles),
        "hour_distribution": distribution.hour_distribution(flow, roles),
        "weekday_distribution": distribution.weekday_distribution(flow, roles),
        "protocol_distribution": distribution.protocol_distribution(flow, roles),
        "protocol_attack_relation": distribution.protocol_attack_relation(flow, roles),
        "service_distribution": distribution.service_distribution(flow, roles),
        "port_distribution": distribution.port_distribution(flow, roles),
        "label_distribution": distribution.label_distribution(flow, roles),
        "category_distribution": distribution.category_distribution(flow, roles),
        "attack_hours": distribution.attack_hours(flow, roles),
        "segment_distribution": distribution.segment_distribution(flow, roles),
        "dos_profile": behavior.dos_profile(flow, roles),
        "top_sources": behavior.top_sources(flow, roles),
        "top_destinations": behavior.top_destinations(flow, roles),
        "top_pairs": behavior.top_pairs(flow, roles),
        "cluster_profile": anomaly.cluster_profile(clustered, roles),
        "anomaly_report": anomaly.anomaly_report(clustered, roles),
        "anomalies": anomaly.anomalies(clustered, roles),
        "summary": report.summary(flow, roles),
        "key_findings": report.key_findings(flow, roles),
    }
    later = {"trend_points", "moving_average", "kpis", "chart_series"}
    assert reports["moving_average"].columns == ["time_index", "total_bytes", "bytes_moving_avg"]
    assert reports["moving_average"].count() == flow.count()
    assert set(reports) == set(alone) | later
    for name, expected in alone.items():
        assert rows(reports[name]) == rows(expected), name


def test_shared_aggregates_are_few(reports):
    # scalars, cells, top values, host pairs, cluster sums
    assert len(reports.held) == 4  # host pairs are written


def test_key_findings(reports, rows):
    assert rows(reports["key_findings"], "finding", "value", "count") == [
        ("main_protocol", "tcp", 59), ("peak_hour", "22", 11), ("top_label", "0", 80),
    ]


def test_kpis_and_summary(reports, rows):
    assert rows(reports["summary"]) == [(86, 2, 12)]
    assert dict(rows(reports["kpis"])) == {
        "total": 86.0, "attacks": 6.0, "attack_ratio": 6 / 86, "anomaly_ratio": 6 / 86,
    }


def test_chart_series(reports, rows):
    series = rows(reports["chart_series"])
    assert [s for s in series if s[0] == "label"] == [("label", "0", 80), ("label", "1", 6)]
    assert sum(n for kind, _, n in series if kind == "hour") == 86
    assert [s[1] for s in series if s[0] == "host"] == [f"10.0.0.{i}" for i in (0, 1, 2, 3, 9)]


def test_sections(flow, roles):
    found = report.analyze(flow, roles, sections=["hosts"])
    assert set(found) == {"top_sources", "top_destinations", "top_pairs"}
    found.release()
    with pytest.raises(ValueError, match="nonsense"):
        report.analyze(flow, roles, sections=["nonsense"])


def test_balanced_analysis(flow, roles):
    found = report.analyze(flow, roles, sections=["attack"], balanced=True)
    sizes = {r.label: r["count"] for r in found["label_distribution"].collect()}
    assert sizes[0] == 80 and 40 < sizes[1] <= 80
    found.release()


def test_write_reports(reports, tmp_path):
    chosen = {name: reports[name] for name in ("overview", "anomalies")}
    run = Path(write_reports(chosen, str(tmp_path), "20240101_000000", {"anomalies": "csv"}))
    assert run == tmp_path / "analysis_20240101_000000"
    (line,) = [p.read_text() for p in (run / "overview").glob("*.json") if p.stat().st_size]
    assert json.loads(line) == {"records": 86, "columns": 12}
    records = [r for p in (run / "anomalies").glob("*.csv") for r in csv.DictReader(p.open())]
    assert len(records) == 6 and {r["attack_category"] for r in records} == {"DoS"}


def test_readers_see_whole_sets_only(spark, tmp_path):
    folder = str(tmp_path)
    one, two = (spark.range(n).withColumnRenamed("id", "n") for n in (3, 5))
    publish_reports({"a": one, "b": two}, folder, "first", {"b": "csv"})
    assert {name: report.count() for name, report in read_reports(spark, folder).items()} == {"a": 3, "b": 5}

    bad = spark.range(4).selectExpr("raise_error('stopped') AS n")
    with pytest.raises(Exception, match="stopped"):
        publish_reports({"a": two, "b": bad}, folder, "second")
    assert {name: report.count() for name, report in read_reports(spark, folder).items()} == {"a": 3, "b": 5}
    assert read_reports(spark, folder, "second") == {}

    publish_reports({"a": two}, folder, "second")
    assert {name: report.count() for name, report in read_reports(spark, folder).items()} == {"a": 5}
    publish_reports({"a": one}, folder, "second")
    assert read_reports(spark, folder, "second")["a"].dtypes == [("n", "bigint")]
    assert read_reports(spark, folder, "second")["a"].count() == 3
    assert read_reports(spark, folder, "first")["b"].count() == 5


def test_prepare_flows(flow):
    table = flow.selectExpr("*", "if(sport = 1030, null, 'FIN') AS flag")
    found = prepare.prepare_flows(table, rel_error=0)
    assert {"total_bytes", "bytes_ratio", "service_index", "service_encoded", "flag_encoded",
            "label_index", "attack_category_index"} <= set(found.columns)
    assert found.count() == 80  # the six far rows are outliers


def test_prepare_flows_keeps_the_normal_category(spark, flow):
    found = prepare.prepare_flows(flow.fillna({"attack_category": "normal"}), rel_error=0)
    assert found.select("attack_category_index").distinct().count() == 1


def test_prepare_connections(spark):
    df = spark.createDataFrame(
        [("tcp", "http", "SF", 1.0, "smurf."), ("tcp", "dns", "S0", None, "normal"),
         ("udp", "dns", "SF", 5.0, None)],
        "protocol_type string, service string, flag string, duration double, attack_type string",
    )
    found = prepare.prepare_connections(df, default_taxonomy(spark)).orderBy("attack_type")
    assert found.columns == [
        "duration", "attack_type", "protocol_type_indexed", "service_indexed", "flag_indexed",
        "attack_category",
    ]
    got = [tuple(r) for r in found.collect()]
    assert got == [
        (1.0, "normal", 0.0, 0.0, 0.0, "normal"), (1.0, "smurf.", 0.0, 1.0, 1.0, "dos"),
    ]
