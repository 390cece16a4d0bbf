import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlens import Roles
from flowlens.operators import encode

# "small" keeps codes on the driver, "large" forces the join.
SIZES = {"small": encode.MAX_LABELS, "large": 0}


@pytest.fixture
def flags(spark):
    # b is most frequent, a and c tie.
    values = ["b", "b", "b", "c", "a", "a", "c", "d"]
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, flag string")


CODES = {"b": 0.0, "a": 1.0, "c": 2.0, "d": 3.0}


@pytest.mark.parametrize("size", SIZES)
def test_codes_by_frequency_then_name(spark, flags, size):
    found = encode.index_categories(flags, ["flag"], max_labels=SIZES[size])
    assert found.columns == ["i", "flag_indexed"]
    expected = [CODES[r.flag] for r in flags.orderBy("i").collect()]
    assert [r.flag_indexed for r in found.orderBy("i").collect()] == expected


@pytest.mark.parametrize("size", SIZES)
def test_null_is_an_error_by_default(spark, flags, size):
    with_null = flags.union(spark.createDataFrame([(9, None)], flags.schema))
    with pytest.raises(Exception, match="(?i)null"):
        encode.index_categories(with_null, ["flag"], max_labels=SIZES[size]).collect()


@pytest.mark.parametrize("size", SIZES)
def test_null_gets_the_code_after_the_last(spark, flags, size):
    with_null = flags.union(spark.createDataFrame([(9, None)], flags.schema))
    found = encode.index_categories(with_null, ["flag"], keep=True, max_labels=SIZES[size])
    assert found.columns == ["i", "flag", "flag_index"]
    assert found.filter("i = 9").first().flag_index == 4.0


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("null", [True, False])
def test_one_hot(spark, flags, size, null):
    df = flags.union(spark.createDataFrame([(9, None)], flags.schema)) if null else flags
    found = encode.one_hot(df, ["flag"], max_labels=SIZES[size])
    vectors = {
        r.flag: r.v
        for r in found.select("flag", vector_to_array("flag_encoded").alias("v")).collect()
    }
    assert vectors["b"] == [1.0, 0.0, 0.0, 0.0] and vectors["d"] == [0.0, 0.0, 0.0, 1.0]
    if null:
        assert vectors[None] == [0.0] * 4


@pytest.mark.parametrize("size", SIZES)
def test_index_labels(spark, size):
    df = spark.createDataFrame(
        [(1, "DoS"), (1, "normal"), (0, "normal")], "label int, attack_category string"
    )
    found = encode.index_labels(df, Roles.resolve(df), max_labels=SIZES[size])
    got = {(r.label, r.attack_category): (r.label_index, r.attack_category_index) for r in found.collect()}
    assert got == {(1, "DoS"): (0.0, 1.0), (1, "normal"): (0.0, 0.0), (0, "normal"): (1.0, 0.0)}
    nothing = df.select(F.lit(1).alias("x"))
    assert encode.index_labels(nothing, Roles()) is nothing


def test_vocabularies_are_counted_in_one_pass(spark, flags, tmp_path, monkeypatch):
    """Only the common count reads the rows; each column's words come from what it wrote."""
    path = str(tmp_path / "flags")
    flags.withColumn("kind", F.col("flag")).write.parquet(path)
    read, number_rows = [], encode.number_rows

    def recorded(words, *args, **options):
        read.extend(words.inputFiles())
        return number_rows(words, *args, **options)

    monkeypatch.setattr(encode, "number_rows", recorded)
    found = encode.index_categories(spark.read.parquet(path), ["flag", "kind"], keep=True, max_labels=0)
    assert read and not any(path in name for name in read)
    assert {(r.flag, r.flag_index, r.kind_index) for r in found.collect()} == {(v, c, c) for v, c in CODES.items()}
