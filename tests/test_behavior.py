import pytest

from flowlens import Roles
from flowlens.operators import behavior as b


@pytest.fixture
def flow(spark):
    return spark.createDataFrame(
        [
            ("a", "x", 2**31 - 1, 1, 1.0, "DoS", 1.0, 10.0, 0.9, 0.0),
            ("a", "x", 2**31 - 1, 2, None, "DoS", 2.0, 20.0, 0.5, 0.5),
            ("b", "x", 10, 3, 2.0, "Analysis", 3.0, 30.0, 0.0, 0.6),
            ("b", "y", 10, 4, 4.0, "normal", 4.0, 40.0, None, 0.7),
            ("c", "y", None, 5, 5.0, None, 5.0, 50.0, None, None),
        ],
        "srcip string, dstip string, sbytes int, dbytes int, dur double, attack_category string, "
        "count double, srv_count double, serror_rate double, rerror_rate double",
    )


@pytest.fixture
def roles(flow):
    return Roles.resolve(flow)


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_families_by_category_or_attack_name(spark):
    df = spark.createDataFrame(
        [("neptune.", "dos"), ("satan", "probe"), (None, "DoS"), (None, None), ("phf", "r2l")],
        "attack_type string, attack_category string",
    )
    roles = Roles.resolve(df)
    assert [r[0] for r in b.dos_rows(df, roles).collect()] == ["neptune.", None]
    assert [r[0] for r in b.probe_rows(df, roles).collect()] == ["satan"]
    assert b.attack_rows(df, roles).count() == 4
    with pytest.raises(ValueError, match="category"):
        b.dos_rows(df, Roles())


def test_profiles(flow, roles):
    assert ordered(b.dos_profile(flow, roles)) == [(float(2**31 - 1), 1.5, 1.0, 2)]
    assert ordered(b.probe_profile(flow, roles)) == [(3.0, 30.0, 1)]
    assert b.probe_profile(flow, roles).columns == ["avg_count", "avg_srv_count", "count"]
    assert ordered(b.dos_profile(flow.filter("srcip = 'c'"), roles)) == []


def test_hosts(flow, roles):
    big = 2 * (2**31 - 1)
    assert ordered(b.top_sources(flow, roles)) == [
        ("a", 2, big, 3), ("b", 2, 20, 7), ("c", 1, None, 5),
    ]
    assert ordered(b.top_sources(flow, roles, k=1)) == [("a", 2, big, 3)]
    assert ordered(b.top_destinations(flow, roles)) == [("x", 3, 6), ("y", 2, 9)]
    assert ordered(b.top_pairs(flow, roles)) == [
        ("a", "x", 2, 1.0), ("b", "x", 1, 2.0), ("b", "y", 1, 4.0), ("c", "y", 1, 5.0),
    ]


def test_host_pairs_give_the_same_rankings(flow, roles):
    pairs = b.host_pairs(flow, roles)
    for report in (b.top_sources, b.top_destinations, b.top_pairs):
        assert ordered(report(pairs, roles, paired=True)) == ordered(report(flow, roles)), report.__name__


def test_high_frequency_is_strictly_above(flow):
    assert ordered(b.high_frequency(flow, "count", 0.6, rel_error=0)) == [(3.0, 2, 0.4)]
    assert ordered(b.high_frequency(flow, "count", 1.0, rel_error=0)) == [(5.0, 0, 0.0)]
    empty = flow.filter("false")
    assert ordered(b.high_frequency(empty, "count", rel_error=0)) == [(None, 0, 0.0)]


def test_high_error(flow):
    cols = ["serror_rate", "rerror_rate"]
    assert ordered(b.high_error(flow, cols)) == [(3, 0.6)]
    assert ordered(b.high_error(flow.filter("false"), cols)) == [(0, 0.0)]


def test_attack_filter_reaches_the_scan(spark, flow, roles, tmp_path):
    path = str(tmp_path / "flow")
    flow.write.parquet(path)
    plan = b.attack_rows(spark.read.parquet(path), roles)._jdf.queryExecution().executedPlan()
    assert "IsNotNull(attack_category)" in plan.toString()


def test_means_of_whole_numbers_take_one_pass(spark, monkeypatch):
    """Only columns that are not whole numbers are summed in a second pass; means stay exact."""
    asked, moments = [], b.exact.moments

    def recorded(df, found, **options):
        asked.append(sorted(found))
        return moments(df, found, **options)

    monkeypatch.setattr(b.exact, "moments", recorded)
    data = [("DoS", 2**62, 1, 0.5), ("DoS", 2**62 + 1, None, 1.0), ("DoS", 3, None, None), ("normal", 9, 9, 9.0)]
    df = spark.createDataFrame(data, "category string, src_bytes long, dst_bytes long, duration double")
    roles = Roles(category="category", src_bytes="src_bytes", dst_bytes="dst_bytes", duration="duration")
    assert tuple(b.dos_profile(df, roles).first()) == (float((2**63 + 4) / 3), 1.0, 0.75, 3)
    assert asked == [["duration"]]
