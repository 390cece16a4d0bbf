"""Flow tables from CSV."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.fixed import FLOW_FIELDS
from flowlens.operators.derive import attack_category
from flowlens.roles import Roles

FLOW_SCHEMA = FLOW_FIELDS.strip()
FLOW_TYPES = dict(field.split() for field in FLOW_SCHEMA.split(","))


def normal_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trimmed lower-case column names with underscores, in one projection."""
    return df.toDF(*(normal_name(name) for name in df.columns))


def _first_line(spark: SparkSession, path: str) -> str:
    lines = spark.read.text(path).take(1)
    return lines[0].value if lines else ""


def _headed(spark: SparkSession, path: str) -> tuple[str, bool]:
    """A first line, and whether the files begin with a header."""
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), place.alias("place"), "value"
    )
    heads = lines.groupBy("file").agg(F.min_by("value", "place").alias("head"))
    is_header = F.lower(F.split("head", ",")[0]).contains("srcip")
    found = heads.agg(F.count("*").alias("n"), F.count_if(is_header).alias("headed"), F.min("head").alias("head"))
    row = found.first()
    if row.headed not in (0, row.n):
        raise ValueError(f"{row.headed} of {row.n} files begin with a header; read them apart")
    return row.head or "", row.n > 0 and row.headed == row.n


def read_flows(
    spark: SparkSession,
    path: str,
    header: bool | Literal["auto"] = "auto",
    declared_types: bool = True,
) -> DataFrame:
    """Flow CSV with ``attack_category`` added.

    Without a header the fixed schema applies. With one, types come from the fixed schema by name
    (other columns become strings); ``declared_types=False`` infers them, which reads the input
    twice. ``auto`` looks at the first line of each file and refuses a mixed folder.
    """
    first = ""
    if header == "auto":
        first, header = _headed(spark, path)
    elif header and declared_types:
        first = _first_line(spark, path)
    if not header:
        df = spark.read.schema(FLOW_SCHEMA).csv(path)
    elif declared_types:
        names = [normal_name(name.strip('"')) for name in first.split(",")]
        schema = ", ".join(f"`{n}` {FLOW_TYPES.get(n, 'string')}" for n in names)
        df = spark.read.schema(schema).csv(path, header=True, enforceSchema=True)
    else:
        df = normalize_columns(spark.read.csv(path, header=True, inferSchema=True))
    if "attack_cat" not in df.columns and "label" not in df.columns:
        return df
    return attack_category(df, Roles.resolve(df))
