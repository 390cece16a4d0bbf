import random
from collections import Counter

import pytest

from flowlens import Roles
from flowlens.operators import distribution, profile
from flowlens.plans import heavy
from flowlens.plans.measures import measure, measure_together


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [
            (1, 5, 1.0, 2.5, "tcp", "DoS", 1),
            (2, 5, None, 2.5, "tcp", None, 0),
            (4, 5, 3.0, 2.5, None, "Normal", 0),
            (None, 2**40, None, 2.5, "udp", "Worms", 1),
        ],
        "sport int, stcpb bigint, dur double, f float, proto string, attack_cat string, label int",
    )


@pytest.fixture
def empty(table):
    return table.filter("false")


def test_overview(table, empty, rows):
    assert rows(profile.overview(table)) == [(4, 7)]
    assert rows(profile.overview(empty)) == [(0, 7)]


def test_numeric_profile(table, empty, rows):
    found = {r[0]: r[1:] for r in rows(profile.numeric_profile(table))}
    assert list(found) == sorted(["sport", "stcpb", "dur", "f", "label"])
    assert found["dur"] == (2.0, pytest.approx(2**0.5), 1.0, 3.0, 2)
    assert found["stcpb"][3:] == (float(2**40), 4)
    assert found["f"] == (2.5, 0.0, 2.5, 2.5, 4)
    assert len(rows(profile.numeric_profile(table, limit=2))) == 2
    assert {r[0]: r[1:] for r in rows(profile.numeric_profile(empty))}["dur"] == (
        None, None, None, None, 0,
    )


def test_categorical_top(table, rows):
    assert rows(profile.categorical_top(table, cols=1)) == [
        ("proto", "tcp", 2, 1), ("proto", "udp", 1, 3), ("proto", None, 1, 2),
    ]
    assert profile.categorical_top(table).count() == 7
    assert profile.categorical_top(table, k=1).count() == 2


def test_missing_counts(table, rows):
    assert dict(rows(profile.missing_counts(table))) == {
        "sport": 1, "stcpb": 0, "dur": 2, "f": 0, "proto": 1, "attack_cat": 1, "label": 0,
    }


def test_data_stats(table, empty, rows):
    roles = Roles.resolve(table)
    assert rows(profile.data_stats(table, roles)) == [(4, 2, 2, 0.5, 6)]
    assert rows(profile.data_stats(empty, roles)) == [(0, 0, 0, 0.0, 6)]
    by_label = Roles(label="label")
    assert rows(profile.data_stats(table, by_label), "attacks") == [(2,)]


def test_attack_type_counts(spark, rows):
    df = spark.createDataFrame([("back",), ("back",), (None,)], "attack_type string")
    assert rows(profile.attack_type_counts(df, Roles.resolve(df))) == [("back", 2), (None, 1)]


def test_measures_agree_alone_and_together(table, rows):
    roles = Roles.resolve(table)
    parts = {
        "overview": profile.overview_measure(table),
        "numeric": profile.numeric_measure(table),
        "missing": profile.missing_measure(table),
        "stats": profile.data_stats_measure(table, roles),
    }
    together = measure_together(table, parts, lambda df: df)
    for name, part in parts.items():
        assert rows(together[name]) == rows(measure(table, part))


def test_top_values_counts_buckets_first(spark, table, rows):
    assert rows(distribution.top_values(table, ["proto"], 2)) == [("proto", "tcp", 2, 1), ("proto", None, 1, 2)]


def plain_top(values, k):
    found = []
    for column in {c for c, _ in values}:
        counted = Counter(v for c, v in values if c == column)
        order = sorted(counted.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
        found += [(column, v, n, i) for i, (v, n) in enumerate(order[:k], 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("shape", ["heavy", "even", "ties", "few"])
def test_heavy_values_are_exact(spark, rows, shape, monkeypatch):
    rng = random.Random(shape)
    draw = {
        "heavy": lambda: str(rng.choice([1, 2, 3])) if rng.random() < 0.5 else str(rng.randrange(2000)),
        "even": lambda: str(rng.randrange(1500)),
        "ties": lambda: str(rng.choice([None, "a", "b", "c", "d"])),
        "few": lambda: rng.choice([None, "x"]),
    }[shape]
    values = [("p", draw()) for _ in range(3000)] + [("q", "1")] * 5 + [("q", None)]
    df = spark.createDataFrame(values, "column string, value string").repartition(6)
    assert rows(heavy.heavy_values(df, 3, buckets=64, first=2)) == plain_top(values, 3)
    assert rows(heavy.heavy_values(df.where("false"), 3)) == []


def test_proved_values_shuffle_only_their_buckets(spark, monkeypatch):
    """With a few heavy values among many, hardly any distinct value is counted on its own."""
    seen = []
    ranked = heavy._ranked
    monkeypatch.setattr(heavy, "_ranked", lambda counted: seen.append(counted.count()) or ranked(counted))
    df = spark.range(60_000).selectExpr("'c' AS column", "IF(id % 3 = 0, id % 4, id) AS value")
    df = df.selectExpr("column", "CAST(value AS string) AS value")
    found = heavy.heavy_values(df, 3, buckets=4096, first=2).collect()
    assert sorted(r.value for r in found) == ["0", "1", "2"] or len(found) == 3
    assert len(seen) == 1 and seen[0] < 200
