"""Event streams of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.fixed import EVENT_FIELDS

EVENT_SCHEMA = EVENT_FIELDS.strip()


def parse_events(lines: DataFrame, schema: str = EVENT_SCHEMA) -> DataFrame:
    """Typed fields from the JSON text in ``value``; a bad line gives nulls."""
    text = F.col("value").cast("string")
    return lines.select(F.from_json(text, schema).alias("data")).select("data.*")


def read_event_stream(
    spark: SparkSession, source: str = "text", schema: str = EVENT_SCHEMA, **options: str
) -> DataFrame:
    """Stream of events from ``source``: ``text`` with ``path=...``, or ``kafka``
    with its usual options."""
    return parse_events(spark.readStream.format(source).options(**options).load(), schema)
