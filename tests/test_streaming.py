import datetime as dt
import json
import os
from pathlib import Path

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from flowlens import Roles
from flowlens.sources import parse_events, read_event_stream
from flowlens.streaming import alerts, progress, traffic

ROLES = Roles(
    src="src_ip", ts="timestamp", src_bytes="src_bytes", dst_bytes="dst_bytes", duration="duration"
)
START = dt.datetime(2024, 1, 1)


def event(second, src="10.0.0.1", src_bytes=10, duration=1.0):
    stamp = (START + dt.timedelta(seconds=second)).isoformat() + "Z"
    return json.dumps({"timestamp": stamp, "src_ip": src, "src_bytes": src_bytes, "dst_bytes": 1,
                       "duration": duration})


def as_stream(spark, folder, *files):
    """A stream that takes one file per batch, in the given order."""
    for i, lines in enumerate(files):
        path = folder / f"{i}.json"
        path.write_text("\n".join(lines) + "\n")
        stamp = 1_700_000_000 + i
        os.utime(path, (stamp, stamp))
    return read_event_stream(spark, "text", path=str(folder), maxFilesPerTrigger="1")


@pytest.fixture
def folders(tmp_path):
    source, state, out = tmp_path / "in", tmp_path / "state", tmp_path / "out"
    source.mkdir()
    return source, str(state), str(out)


def run(df, state, out, sink="parquet"):
    alerts.write_alerts(df, sink, state, available_now=True, path=out).awaitTermination()


def test_stream_equals_batch_over_closed_windows(spark, folders, rows):
    source, state, out = folders
    files = [[event(s, f"h{s % 3}") for s in range(k * 100, k * 100 + 100, 7)] for k in range(4)]
    stream = traffic.with_late_bound(as_stream(spark, source, *files), "timestamp")
    assert stream.isStreaming
    run(traffic.windowed_traffic(stream, ROLES), state, out)
    got = traffic.window_bounds(spark.read.parquet(out))

    lines = spark.createDataFrame([(line,) for lines in files for line in lines], "value string")
    batch = traffic.window_bounds(traffic.windowed_traffic(parse_events(lines), ROLES))
    last = START + dt.timedelta(seconds=396 - 10)
    closed = batch.filter(F.col("window_end") <= F.lit(last))
    assert closed.count() > 20 and rows(got) == rows(closed)


def test_sliding_windows(spark, rows):
    at = [(START + dt.timedelta(seconds=s), "a", 10, 1, 2.0) for s in (5, 35, 65)]
    df = spark.createDataFrame(
        at, "timestamp timestamp, src_ip string, src_bytes int, dst_bytes int, duration double"
    )
    found = traffic.window_bounds(traffic.windowed_traffic(df, ROLES)).orderBy("window_start")
    starts = [(r.window_start - START).total_seconds() for r in found.collect()]
    assert starts == [-30.0, 0.0, 30.0, 60.0]
    assert [r.connection_count for r in found.collect()] == [1, 2, 2, 1]
    assert [r.bytes_per_connection for r in found.collect()] == [10.0] * 4


def test_late_rows(spark, folders):
    """Rows behind the watermark are dropped, rows inside it still count."""
    source, state, out = folders
    files = [
        [event(5), event(59)],
        [event(68)],  # watermark moves to second 58
        [event(57)],  # behind it, but its window is still open
        [event(200)],
        [event(201)],  # the watermark is at second 190 by now
        [event(30)],  # too late
        [event(300)],
    ]
    stream = traffic.with_late_bound(as_stream(spark, source, *files), "timestamp")
    run(traffic.windowed_traffic(stream, ROLES, "1 minute", None), state, out)
    found = traffic.window_bounds(spark.read.parquet(out))
    counts = {(r.window_start - START).seconds: r.connection_count for r in found.collect()}
    assert counts == {0: 3, 60: 1, 180: 2}


def test_counts_per_flag(spark, rows):
    data = [(START + dt.timedelta(seconds=s), s % 2 == 0) for s in (1, 2, 59, 60)]
    df = spark.createDataFrame(data, "timestamp timestamp, is_attack boolean")
    found = traffic.window_bounds(traffic.windowed_counts(df, "timestamp"))
    assert rows(found, "is_attack", "count") == [(False, 2), (True, 1), (True, 1)]


@pytest.mark.parametrize(
    ("connections", "duration", "per_connection", "level"),
    [
        (1001, 0.09, 0.0, "HIGH"),
        (1000, 0.09, 0.0, "LOW"),
        (1001, 0.1, 0.0, "LOW"),
        (1001, 0.05, 20000.0, "HIGH"),
        (101, 1.0, 10000.5, "MEDIUM"),
        (100, 1.0, 10000.5, "LOW"),
        (101, 1.0, 10000.0, "LOW"),
        (5000, None, 20000.0, "MEDIUM"),
        (5000, None, None, "LOW"),
    ],
)
def test_alert_levels(spark, connections, duration, per_connection, level):
    df = spark.createDataFrame(
        [(connections, duration, per_connection)],
        "connection_count long, avg_duration double, bytes_per_connection double",
    )
    found = alerts.alert_rules(df).first()
    reasons = {
        "HIGH": "Possible DDoS attack detected",
        "MEDIUM": "Suspicious traffic pattern",
        "LOW": "Normal",
    }
    assert (found.alert_level, found.alert_reason) == (level, reasons[level])
    assert isinstance(found.alert_time, dt.datetime)


def test_thresholds_are_parameters(spark):
    df = spark.createDataFrame(
        [(3, 5.0, 1.0)],
        "connection_count long, avg_duration double, bytes_per_connection double",
    )
    rules = alerts.Rules(flood_connections=2, flood_duration=6.0)
    assert alerts.alert_rules(df, rules).first().alert_level == "HIGH"


def test_two_sinks_with_their_own_checkpoints(spark, folders):
    source, state, out = folders
    stream = traffic.with_late_bound(
        as_stream(spark, source, [event(s) for s in range(0, 300, 10)]), "timestamp"
    )
    raised = alerts.alert_rules(traffic.windowed_traffic(stream, ROLES))
    queries = alerts.start_alerts(
        raised, {"memory": {"queryName": "seen"}, "text": {"path": out}}, state, available_now=True
    )
    for query in queries:
        query.awaitTermination()
    assert len(queries) == 2
    assert {p.name for p in Path(state).iterdir()} == {"memory", "text"}
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert len(lines) == spark.table("seen").count() > 5
    assert set(lines[0]) == {
        "window", "src_ip", "connection_count", "total_src_bytes", "total_dst_bytes",
        "avg_duration", "bytes_per_connection", "alert_level", "alert_reason", "alert_time",
    }


def test_one_state_for_several_sinks(spark, folders, rows):
    """A sink that fails after another has written: after a restart both have every row once."""
    source, state, out = folders
    files = [[event(s, f"h{s % 3}") for s in range(k * 100, k * 100 + 100, 10)] for k in range(3)]
    stream = traffic.with_late_bound(as_stream(spark, source, *files), "timestamp")
    found = traffic.windowed_traffic(stream, ROLES)
    calls = []
    second = alerts.file_sink("json", f"{out}/two")

    def failing(batch, number):
        calls.append(number)
        if len(calls) == 2:
            raise RuntimeError("stopped between the sinks")
        second(batch, number)

    sinks = {"one": alerts.file_sink("parquet", f"{out}/one"), "two": failing}
    with pytest.raises(Exception, match="stopped between"):
        alerts.write_to_all(found, sinks, state, available_now=True).awaitTermination()
    alerts.write_to_all(found, sinks, state, available_now=True).awaitTermination()
    assert calls[1] == calls[2]  # the same batch again
    one, two = (
        rows(traffic.window_bounds(alerts.read_batches(found, kind, f"{out}/{name}")))
        for kind, name in (("parquet", "one"), ("json", "two"))
    )
    lines = spark.createDataFrame([(line,) for lines in files for line in lines], "value string")
    batch = traffic.window_bounds(traffic.windowed_traffic(parse_events(lines), ROLES))
    closed = batch.filter(F.col("window_end") <= F.lit(START + dt.timedelta(seconds=280)))
    assert one == two == rows(closed) and len(one) > 10


@pytest.mark.parametrize("spread", [2, 16])
def test_spread_sources_have_the_same_windows(spark, folders, rows, spread):
    source, state, out = folders
    lines = [event(s / 3, "hot" if s % 3 else f"h{s % 5}", duration=0.1 * (s % 7)) for s in range(900)]
    stream = traffic.with_late_bound(as_stream(spark, source, lines[:400], lines[400:], [event(900)]), "timestamp")
    run(traffic.windowed_traffic(stream, ROLES, spread=spread), state, out)
    got = traffic.window_bounds(spark.read.parquet(out))
    whole = parse_events(spark.createDataFrame([(line,) for line in [*lines, event(900)]], "value string"))
    batch = traffic.window_bounds(traffic.windowed_traffic(whole, ROLES))
    closed = batch.filter(F.col("window_end") <= F.lit(START + dt.timedelta(seconds=890)))
    near = [(*r[:-2], pytest.approx(r[-2]), r[-1]) for r in rows(closed)]
    assert rows(got) == near and len(near) > 50


def test_late_rows_are_told_from_progress(spark, folders):
    source, state, out = folders
    stream = traffic.with_late_bound(as_stream(spark, source, [event(5), event(200)], [event(201)], [event(30), event(190)]), "timestamp")
    query = alerts.write_alerts(
        traffic.windowed_traffic(stream, ROLES, "1 minute", None), "parquet", state, available_now=True, path=out
    )
    query.awaitTermination()
    marks = progress.watermarks(query)
    assert len(marks) == 3 and progress.dropped(query) == 1
    last = parse_events(spark.createDataFrame([(event(30),), (event(190),)], "value string"))
    late = progress.late_rows(last, "timestamp", "1 minute", marks[max(marks)]).collect()
    assert [r.timestamp for r in late] == [START + dt.timedelta(seconds=30)]
    assert progress.late_rows(last, "timestamp", "1 minute", progress.EPOCH).count() == 0


def test_scoring_with_a_saved_model(spark, folders, rows):
    source, state, out = folders
    lines = [event(s, src_bytes=10 if s % 2 else 9000, src=f"h{s % 2}") for s in range(0, 400, 7)]
    stream = as_stream(spark, source, lines)
    batch = parse_events(spark.createDataFrame([(line,) for line in lines], "value string"))
    windows = traffic.windowed_traffic(batch, ROLES)
    assembler = VectorAssembler(inputCols=["bytes_per_connection"], outputCol="features")
    model = Pipeline(stages=[assembler, KMeans(k=2, seed=42)]).fit(windows)
    model.save(f"{state}-model")

    late = traffic.with_late_bound(stream, "timestamp")
    scored = alerts.score_stream(traffic.windowed_traffic(late, ROLES), f"{state}-model")
    run(scored.drop("features"), state, out)
    got = traffic.window_bounds(spark.read.parquet(out))
    want = traffic.window_bounds(model.transform(windows).drop("features"))
    closed = want.filter(F.col("window_end") <= F.lit(START + dt.timedelta(seconds=389)))
    assert rows(got) == rows(closed) and {r.prediction for r in got.collect()} == {0, 1}


def test_rules_stand_in_for_a_missing_model(spark):
    df = spark.createDataFrame(
        [(3, 5.0, 1.0)],
        "connection_count long, avg_duration double, bytes_per_connection double",
    )
    assert "alert_level" in alerts.score_stream(df, None).columns
