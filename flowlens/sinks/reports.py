"""Reports as files, one directory per report."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlens.plans.small import small_table

_MANIFEST = "set string, name string, path string, format string, schema string"


def _stamp(stamp: str | None) -> str:
    return stamp or datetime.now().strftime("%Y%m%d_%H%M%S")


def _write(report: DataFrame, kind: str, path: str) -> None:
    writer = report.write.format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_reports(
    reports: Mapping[str, DataFrame],
    folder: str,
    stamp: str | None = None,
    formats: Mapping[str, str] | None = None,
) -> str:
    """Write every report below ``folder/analysis_<stamp>`` and return that path.

    Reports are JSON unless ``formats`` names another format, for instance
    ``{"anomalies": "csv"}``. Each report is written by its own tasks.
    """
    run = f"{folder}/analysis_{_stamp(stamp)}"
    for name, report in reports.items():
        _write(report, (formats or {}).get(name, "json"), f"{run}/{name}")
    return run


def publish_reports(
    reports: Mapping[str, DataFrame],
    folder: str,
    stamp: str | None = None,
    formats: Mapping[str, str] | None = None,
) -> str:
    """Write a set of reports that readers see whole or not at all; returns its stamp.

    The reports go to a folder of their own. When all are written, one manifest row each, with path and
    schema, is committed in a single job; ``read_reports`` follows manifests only. A set published again
    under its stamp takes the place of the earlier one.
    """
    spark = next(iter(reports.values())).sparkSession
    stamp, run = _stamp(stamp), f"{folder}/_runs/{uuid.uuid4().hex}"
    rows = []
    for name, report in reports.items():
        kind, path = (formats or {}).get(name, "json"), f"{run}/{name}"
        _write(report, kind, path)
        rows.append((stamp, name, path, kind, report.schema.json()))
    manifest = small_table(spark, rows, _MANIFEST).withColumn("published", F.current_timestamp())
    manifest.coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return stamp


def read_reports(spark: SparkSession, folder: str, stamp: str | None = None) -> dict[str, DataFrame]:
    """The reports published under ``stamp``, or those of the latest set."""
    manifest = spark.read.schema(f"{_MANIFEST}, published timestamp").parquet(f"{folder}/manifest")
    if stamp is not None:
        manifest = manifest.where(F.col("set") == stamp)
    # As many rows as the set has reports.
    latest = manifest.agg(F.max("published")).first()[0]
    rows = [] if latest is None else manifest.where(F.col("published") == latest).collect()
    found = {}
    for row in rows:
        reader = spark.read.format(row.format).schema(StructType.fromJson(json.loads(row.schema)))
        found[row["name"]] = (reader.option("header", True) if row.format == "csv" else reader).load(row.path)
    return found
