import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowlens import Roles
from flowlens.functions.columns import hour_of_epoch, ip_number, is_attack, is_ipv4, share
from flowlens.operators import derive

BYTES = Roles(src_bytes="src_bytes", dst_bytes="dst_bytes")


def test_binary_label(spark, rows):
    names = ["normal", "normal.", "Normal", None, "smurf."]
    df = spark.createDataFrame([(n,) for n in names], "attack_type string")
    assert rows(derive.binary_label(df)) == [
        ("Normal", 1), ("normal", 0), ("normal.", 0), ("smurf.", 1), (None, 1),
    ]


def test_attack_category(spark, rows):
    df = spark.createDataFrame([("DoS", 1), ("Normal", 0), (None, 0)], "attack_cat string, label int")
    found = derive.attack_category(df, Roles.resolve(df))
    assert rows(found, "attack_category") == [("DoS",), ("normal",), ("normal",)]
    assert derive.attack_category(found, Roles.resolve(found)) is found
    label_only = spark.createDataFrame([(1,), (None,)], "label int")
    found = derive.attack_category(label_only, Roles.resolve(label_only))
    assert rows(found, "attack_category") == [("1",), ("normal",)]


@pytest.mark.parametrize(
    ("roles", "expected"),
    [
        (Roles(category="c"), [False, False, True, False]),
        (Roles(attack="a"), [False, False, True, False]),
        (Roles(label="l"), [False, True, True, False]),
    ],
)
def test_is_attack(spark, roles, expected):
    df = spark.createDataFrame(
        [(0, "normal", "normal.", 0), (1, "Normal", "Normal", 1), (2, "DoS", "smurf.", 7),
         (3, None, None, None)],
        "i int, c string, a string, l int",
    )
    assert [r.x for r in df.orderBy("i").select(is_attack(roles).alias("x")).collect()] == expected


def test_time_features(spark):
    times = [dt.datetime(2024, 1, 6, 23, 59), dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8, 5)]
    df = spark.createDataFrame([(t,) for t in times], "timestamp timestamp")
    found = derive.time_features(df, Roles.resolve(df)).orderBy("timestamp").collect()
    assert [(r.hour, r.day_of_week, r.is_weekend) for r in found] == [
        (23, 7, 1), (0, 1, 1), (5, 2, 0),
    ]
    assert spark.range(1).select(hour_of_epoch(F.lit(1421927414))).first()[0] == 11


def test_bytes(spark, rows):
    big = 2**31 - 1
    df = spark.createDataFrame(
        [(big, big), (10, 4), (10, 0), (10, None), (None, 5)], "src_bytes int, dst_bytes int"
    )
    total = derive.bytes_ratio(derive.total_bytes(df, BYTES), BYTES)
    assert rows(total, "total_bytes", "bytes_ratio") == sorted(
        [(2 * big, 1.0), (14, 2.5), (10, 0.0), (None, 0.0), (None, None)], key=repr
    )


def test_connection_intensity(spark, rows):
    df = spark.createDataFrame([(2.0, 3.0), (None, 1.0)], "count double, srv_count double")
    found = derive.connection_intensity(df, Roles.resolve(df))
    assert rows(found, "connection_intensity") == [(5.0,), (None,)]


def test_traffic_segment(spark):
    totals = [999, 1000, 9999, 10000, 99999, 100000, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(totals)], "i int, total_bytes int")
    roles = Roles.resolve(df)
    found = [r.traffic_segment[0] for r in derive.traffic_segment(df, roles).orderBy("i").collect()]
    assert found == ["小", "中", "中", "大", "大", "超", "超"]
    assert derive.traffic_segment(df, roles, drop_null=True).count() == 6


def test_bytes_per_connection(spark, rows):
    df = spark.createDataFrame([(10, 4), (10, 0)], "total_src_bytes long, connection_count long")
    found = derive.bytes_per_connection(df)
    assert rows(found, "bytes_per_connection") == [(0.0,), (2.5,)]


def test_share_of_nothing(spark):
    found = spark.range(1).select(share(F.lit(1), F.lit(4)), share(F.lit(0), F.lit(0)))
    assert tuple(found.first()) == (0.25, 0.0)


@pytest.mark.parametrize(
    ("address", "shaped", "valid", "number"),
    [
        ("10.0.0.1", True, True, 167772161),
        ("255.255.255.255", True, True, 2**32 - 1),
        ("010.000.0.7", True, True, 167772167),
        ("0.0.0.0", True, True, 0),
        ("10.0.0.256", True, False, None),
        ("999.1.1.1", True, False, None),
        ("10.0.0", False, False, None),
        ("10.0.0.1.5", False, False, None),
        ("10.0.0.1 ", False, False, None),
        ("+1.0.0.1", False, False, None),
        ("a.b.c.d", False, False, None),
        ("", False, False, None),
        (None, None, None, None),
    ],
)
def test_ipv4(spark, address, shaped, valid, number):
    a = F.lit(address).cast("string")
    found = spark.range(1).select(is_ipv4(a), is_ipv4(a, strict=True), ip_number(a)).first()
    assert tuple(found) == (shaped, valid, number)


def test_features_follow_the_columns(spark):
    df = spark.createDataFrame([(1, 2)], "src_bytes int, dst_bytes int")
    assert derive.features(df, Roles.resolve(df)).columns == [
        "src_bytes", "dst_bytes", "total_bytes", "bytes_ratio",
    ]
