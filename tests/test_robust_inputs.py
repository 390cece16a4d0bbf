"""Inputs that once gave wrong answers: clashing names, missing categories, repeated look-ups."""

import pytest
from pyspark.sql import functions as F

from flowlens import Roles
from flowlens.operators import anomaly, behavior, distribution, enrich, profile
from flowlens.plans.quantiles import exact_quantiles
from flowlens.sources import read_flows


def test_a_column_named_rows_is_data(spark, rows):
    df = spark.createDataFrame([("tcp", 5), ("tcp", 7)], "proto string, rows int")
    assert rows(distribution.protocol_distribution(df, Roles.resolve(df))) == [("tcp", 2)]


def test_a_column_named_like_a_pair_sum_is_data(spark, rows):
    df = spark.createDataFrame(
        [("a", "b", 1, 2, 3)], "src_ip string, dst_ip string, src_bytes int, dst_bytes int, timed_connections int"
    )
    assert rows(behavior.top_sources(df, Roles.resolve(df))) == [("a", 1, 1, 2)]


def test_attacks_without_a_category_count(spark, rows):
    df = spark.createDataFrame(
        [("normal", "normal", 0), (None, "mystery.", 1), ("dos", "neptune", 1), (None, None, 1), (None, None, None)],
        "attack_category string, attack_type string, label int",
    )
    found = profile.data_stats(df, Roles.resolve(df)).first()
    assert (found.total, found.attacks, found.normal) == (5, 3, 2)


def test_second_lookup_replaces_or_prefixes(spark, rows):
    flow = spark.createDataFrame([("10.0.0.1", "10.0.0.9", "old")], "src string, dst string, country string")
    ranges = spark.createDataFrame(
        [(10 << 24, (10 << 24) + 4, "A", "x", 1.0, 1.0), ((10 << 24) + 5, (10 << 24) + 9, "B", "y", 2.0, 2.0)],
        "lo long, hi long, country string, city string, latitude double, longitude double",
    )
    for bound in (0, 100):
        once = enrich.enrich_geo(flow, ranges, "src", bound)
        assert rows(once, "country") == [("A",)]
        twice = enrich.enrich_geo(once, ranges, "dst", bound)
        assert twice.columns == ["src", "dst", *enrich.GEO_COLUMNS] and rows(twice, "country") == [("B",)]
        both = enrich.enrich_geo(enrich.enrich_geo(flow, ranges, "src", bound), ranges, "dst", bound, "dst_")
        assert rows(both, "country", "dst_country") == [("A", "B")]
    owners = spark.createDataFrame([("10.0.0.9", "AS1", "o", "i")], "ip string, asn string, organization string, isp string")
    owned = enrich.enrich_owner(enrich.enrich_owner(flow, owners, "src"), owners, "dst")
    assert rows(owned, "asn") == [("AS1",)] and owned.columns.count("asn") == 1


def test_taxonomy_with_repeated_and_dotted_names(spark, rows):
    flow = spark.createDataFrame([("neptune.",), ("normal",)], "attack_type string")
    taxonomy = spark.createDataFrame(
        [("neptune.", "dos"), ("normal", "normal"), ("normal.", "normal")], "attack string, category string"
    )
    found = enrich.categorize(flow, taxonomy, Roles.resolve(flow))
    assert rows(found) == [("neptune.", "dos"), ("normal", "normal")]


def test_quantiles_of_whole_numbers_are_exact(spark):
    base = 2**53
    df = spark.createDataFrame([(base + k,) for k in (1, 3, 5)] + [(None,)], "x bigint")
    assert exact_quantiles(df, "x", [0.5, 1.0]) == [base + 3, base + 5]
    wide = spark.range(1, 20_001).select((F.col("id") * F.col("id") - 10**6).alias("x"))
    assert exact_quantiles(wide, "x", [0.25, 0.5, 0.95]) == [p**2 - 10**6 for p in (5000, 10_000, 19_000)]


def test_clusters_do_not_depend_on_the_layout(spark, rows):
    df = spark.range(3000).select(
        F.col("id").alias("i"),
        (F.pmod(F.xxhash64("id"), F.lit(5000)) + F.when(F.col("id") % 17 == 0, 9000).otherwise(0)).alias("sbytes"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4000)).alias("dbytes"),
        (F.col("id") % 7).cast("double").alias("dur"),
    )
    found = [rows(anomaly.cluster(df.repartition(n), Roles.resolve(df)), "i", "prediction") for n in (1, 8)]
    assert found[0] == found[1]
    sizes = [sum(p == c for _, p in found[0]) for c in (0, 1)]
    assert sizes[0] >= sizes[1] > 0


def test_mixed_folder_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("srcip,label\n10.0.0.1,0\n")
    (tmp_path / "b.csv").write_text("10.0.0.1,1\n")
    with pytest.raises(ValueError, match="1 of 2 files"):
        read_flows(spark, str(tmp_path))


def test_folder_of_files_with_headers(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("srcip,label\n10.0.0.1,0\n")
    (tmp_path / "b.csv").write_text("srcip,label\n10.0.0.2,1\n")
    assert rows(read_flows(spark, str(tmp_path)), "srcip", "label") == [("10.0.0.1", 0), ("10.0.0.2", 1)]
