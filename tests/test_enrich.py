import random

import pytest
from pyspark.sql import functions as F

from flowlens import Roles
from flowlens.operators import enrich

GEO = "lo long, hi long, country string, city string, latitude double, longitude double"
# "small" broadcasts the reference table, "large" forces the shuffled look-up.
SIZES = {"small": 10**6, "large": 0}


def number(address):
    a, b, c, d = map(int, address.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


@pytest.mark.parametrize("size", SIZES)
def test_geo(spark, size):
    ranges = spark.createDataFrame(
        [
            (number("10.0.0.10"), number("10.0.0.19"), "A", "a", 1.0, 2.0),
            (number("10.0.0.20"), number("10.0.0.20"), "B", None, 3.0, 4.0),
            (number("11.0.0.0"), number("200.0.0.0"), "C", "c", 5.0, 6.0),
        ],
        GEO,
    )
    expected = {
        "10.0.0.9": None, "10.0.0.10": "A", "10.0.0.19": "A", "10.0.0.20": "B", "10.0.0.21": None,
        "10.255.255.255": None, "11.0.0.0": "C", "99.1.2.3": "C", "200.0.0.0": "C",
        "200.0.0.1": None, "10.0.0.300": None, "bad": None, None: None,
    }
    df = spark.createDataFrame([(a, i) for i, a in enumerate(expected)], "src_ip string, i int")
    found = enrich.enrich_geo(df, ranges, broadcast_rows=SIZES[size])
    assert found.columns == ["src_ip", "i", "country", "city", "latitude", "longitude"]
    assert {r.src_ip: r.country for r in found.collect()} == expected
    assert found.filter("src_ip = '10.0.0.20'").first()[2:] == ("B", None, 3.0, 4.0)


@pytest.mark.parametrize("size", SIZES)
def test_random_ranges_against_brute_force(spark, size):
    rng = random.Random(1)
    edges = sorted({rng.randrange(2**32) >> rng.choice([0, 8, 20]) for _ in range(400)})
    ranges = [(lo, hi - rng.choice([0, 1]), f"c{lo}") for lo, hi in zip(edges[::2], edges[1::2])]
    ranges = [r for r in ranges if r[0] <= r[1]]
    points = [rng.randrange(2**32) >> rng.choice([0, 8, 20]) for _ in range(300)]
    points += [p for r in ranges for p in (r[0], r[1], r[0] - 1, r[1] + 1) if 0 <= p < 2**32]
    points += [ranges[3][0]] * 2000  # one address holds most rows
    df = spark.createDataFrame([(p,) for p in points], "p long")
    table = spark.createDataFrame(ranges, "lo long, hi long, name string")
    found = enrich.range_lookup(df, table, F.col("p"), SIZES[size])
    assert found.count() == len(points)
    for row in found.distinct().collect():
        names = [name for lo, hi, name in ranges if lo <= row.p <= hi]
        assert [row.name] == (names or [None])


@pytest.mark.parametrize("size", SIZES)
def test_no_ranges(spark, size):
    df = spark.createDataFrame([("10.0.0.1",)], "src_ip string")
    found = enrich.enrich_geo(df, spark.createDataFrame([], GEO), broadcast_rows=SIZES[size])
    assert found.first()[1:] == (None, None, None, None)
    assert enrich.enrich_geo(df, None) is df


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("pair", [[(1, 5), (5, 9)], [(1, 9), (2, 3)], [(4, 3), (10, 11)]])
def test_bad_ranges_are_refused(spark, size, pair):
    ranges = spark.createDataFrame([(lo, hi, "x") for lo, hi in pair], "lo long, hi long, v string")
    with pytest.raises(ValueError, match="overlap"):
        enrich.range_lookup(spark.range(1), ranges, F.col("id"), SIZES[size])


def test_a_cell_holds_at_most_two_ranges(spark):
    rng = random.Random(2)
    edges = sorted(rng.randrange(2**32) >> rng.choice([0, 6, 12, 18, 24]) for _ in range(3000))
    pairs = [(lo, hi - 1) for lo, hi in zip(edges, edges[1:]) if lo < hi]
    table = spark.createDataFrame(pairs, "_lo long, _hi long")
    grids = enrich._on_grids(table)
    per_cell = grids.groupBy("_level", "_cell").count().agg(F.max("count")).first()[0]
    assert per_cell <= 2
    assert grids.groupBy("_lo").count().agg(F.max("count")).first()[0] <= enrich._MAX_CELLS + 1


@pytest.mark.parametrize("size", SIZES)
def test_owner_by_address(spark, size, rows):
    owners = spark.createDataFrame(
        [("10.0.0.1", "AS1", "one", "i"), ("10.0.0.1", "AS2", "two", "i"), (None, "AS3", "x", "i")],
        "ip string, asn string, organization string, isp string",
    )
    df = spark.createDataFrame([("10.0.0.1",), ("10.0.0.2",), (None,)], "src_ip string")
    found = enrich.enrich_owner(df, owners, broadcast_rows=SIZES[size])
    assert rows(found) == [
        ("10.0.0.1", "AS1", "one", "i"), ("10.0.0.2", None, None, None), (None,) * 4,
    ]


def test_owner_by_range(spark, rows):
    owners = spark.createDataFrame(
        [(number("10.0.0.0"), number("10.0.0.255"), "AS1", "one", "i")],
        "lo long, hi long, asn string, organization string, isp string",
    )
    df = spark.createDataFrame([("10.0.0.7",), ("10.0.1.7",)], "src_ip string")
    assert rows(enrich.enrich_owner(df, owners), "asn") == [("AS1",), (None,)]


@pytest.mark.parametrize("size", SIZES)
def test_threat_flag(spark, size, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "src_ip string")
    listed = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "ip string")
    found = enrich.flag_threats(df, listed, broadcast_rows=SIZES[size])
    assert rows(found) == [("a", True), ("a", True), ("b", False), (None, False)]
    none = enrich.flag_threats(df, listed.filter("false"), broadcast_rows=SIZES[size])
    assert rows(none, "is_malicious_ip") == [(False,)] * 4


def test_categorize(spark, rows):
    taxonomy = spark.createDataFrame(
        [("smurf", "dos"), ("normal", "normal")], "attack string, category string"
    )
    df = spark.createDataFrame([("smurf.",), ("normal",), ("new",), (None,)], "attack_type string")
    roles = Roles.resolve(df)
    assert rows(enrich.categorize(df, taxonomy, roles)) == sorted(
        [("smurf.", "dos"), ("normal", "normal"), ("new", None), (None, None)], key=repr
    )
    found = enrich.categorize_or_unknown(df, taxonomy, roles)
    assert rows(found, "attack_category") == [("dos",), ("normal",), ("unknown",), ("unknown",)]
    assert enrich.categorize(df, taxonomy, Roles()) is df


def test_small_tables_are_joined_without_moving_rows(spark):
    df = spark.createDataFrame([("10.0.0.1",)], "src_ip string")
    ranges = spark.createDataFrame([(0, 9, "A", "a", 1.0, 2.0)], GEO)
    plan = enrich.enrich_geo(df, ranges)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "hashpartitioning" not in plan


def test_an_address_is_read_once(spark):
    """However an address is made, its number does not make it again for each octet."""
    made = F.concat_ws(".", F.lit("10"), "id", F.lit("0"), F.lit("7"))
    found = spark.range(300).select(made.alias("ip")).select(enrich.ip_number(F.col("ip")).alias("n")).dropna()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws") <= 2  # in the filter and in the result
    assert [r.n for r in found.orderBy("n").collect()] == [(10 << 24) + (i << 16) + 7 for i in range(256)]


def test_large_look_ups_number_each_address_once(spark, rows, monkeypatch):
    """Rows are counted by address in one pass; cells, many more than the ranges, are not broadcast."""
    staged = {}

    def recorded(df, name):
        staged[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    write = enrich.stage
    monkeypatch.setattr(enrich, "stage", recorded)
    ranges = spark.createDataFrame([(number("10.0.0.0") + 20 * i, number("10.0.0.0") + 20 * i + 14, f"c{i}") for i in range(40)], "lo long, hi long, name string")
    df = spark.range(1000).select((F.col("id") % 100).alias("id"), F.concat(F.lit("10.0.0."), F.col("id") % 100).alias("ip"))
    found = enrich.range_lookup(df, ranges, F.col("ip"), 0, enrich.ip_number)
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "BroadcastHashJoin" not in staged["answers"]
    expected = [(i, f"c{i // 20}" if i % 20 < 15 else None) for i in range(100)]
    assert rows(found.distinct(), "id", "name") == sorted(expected, key=repr)
