"""Readers for flow, connection, reference and event data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.sources.connections import read_connections, rejected_connections, schema_from_names
from flowlens.sources.events import EVENT_SCHEMA, parse_events, read_event_stream
from flowlens.sources.flows import FLOW_SCHEMA, normalize_columns, read_flows
from flowlens.sources.reference import default_taxonomy, read_blocklist, read_taxonomy

__all__ = [
    "EVENT_SCHEMA",
    "FLOW_SCHEMA",
    "default_taxonomy",
    "normalize_columns",
    "parse_events",
    "read_blocklist",
    "read_connections",
    "read_dataset",
    "read_event_stream",
    "read_flows",
    "read_taxonomy",
    "rejected_connections",
    "schema_from_names",
]

# Names of the supported data sets.
DATASETS = ("unsw_nb15", "kddcup99")


def read_dataset(
    spark: SparkSession, dataset: str, path: str, names: str | None = None
) -> DataFrame:
    """Read a data set by name; ``names`` is the column file of the connection data."""
    kind = dataset.lower()
    if kind not in DATASETS:
        raise ValueError(f"unknown data set {dataset!r}, expected one of {', '.join(DATASETS)}")
    if kind == "unsw_nb15":
        return read_flows(spark, path)
    if names is None:
        raise ValueError("connection data needs the path of its names file")
    return read_connections(spark, path, names)
