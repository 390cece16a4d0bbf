"""Connection tables whose columns are listed in a names file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from flowlens.functions.columns import plain_name
from flowlens.operators.derive import binary_label

_BAD_LINE = "_bad_line"


def schema_from_names(spark: SparkSession, path: str) -> StructType:
    """Schema from lines ``name: continuous.`` or ``name: symbolic.``.

    Lines without a colon (the list of classes) and comments are not columns.
    The file is a column list, so it is read as one value.
    """
    text = spark.read.text(path, wholetext=True).first().value
    columns = []
    for line in map(str.strip, text.splitlines()):
        name, colon, kind = line.partition(":")
        if colon and not line.startswith("#"):
            numeric = kind.strip().rstrip(".") == "continuous"
            columns.append(StructField(name.strip(), DoubleType() if numeric else StringType()))
    return StructType([*columns, StructField("attack_type", StringType())])


def _lines(spark: SparkSession, path: str, names: str) -> DataFrame:
    """Every line (``line``) that is not blank, with its columns (``row``); a line that does not fit them is in ``_BAD_LINE``.

    A line is judged by all its columns, whichever of them a query reads; a CSV scan looks only at those.
    """
    schema = schema_from_names(spark, names)
    checked = StructType([*schema.fields, StructField(_BAD_LINE, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_LINE}
    lines = spark.read.text(path).where(F.trim("value") != "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in checked.fields)
    return lines.select(F.col("value").alias("line"), F.from_csv("value", ddl, options).alias("row"))


def read_connections(spark: SparkSession, path: str, names: str) -> DataFrame:
    """Connection CSV with plain attack names and a 0/1 ``label``.

    Lines with too few or too many columns, or with a text where a number belongs, are left out:
    ``rejected_connections`` has them.
    """
    df = _lines(spark, path, names).where(F.col(f"row.{_BAD_LINE}").isNull()).select("row.*").drop(_BAD_LINE)
    named = df.withColumn("attack_type", plain_name(F.col("attack_type")))
    return binary_label(named, "attack_type")


def rejected_connections(spark: SparkSession, path: str, names: str) -> DataFrame:
    """The lines (``line``) that ``read_connections`` leaves out."""
    return _lines(spark, path, names).where(F.col(f"row.{_BAD_LINE}").isNotNull()).select("line")
