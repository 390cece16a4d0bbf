"""Alerts on windowed traffic, and the sinks they go to."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.functions.fixed import (
    FLOOD_CONNECTIONS,
    FLOOD_DURATION,
    HEAVY_BYTES,
    HEAVY_CONNECTIONS,
    HIGH,
    LOW,
    MEDIUM,
    REASONS,
)


@dataclass(frozen=True)
class Rules:
    """Bounds of the alert rules; each must be exceeded (the duration undercut)."""

    flood_connections: int = FLOOD_CONNECTIONS
    flood_duration: float = FLOOD_DURATION
    heavy_bytes: float = HEAVY_BYTES
    heavy_connections: int = HEAVY_CONNECTIONS


def alert_rules(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``alert_level``, ``alert_reason`` and the processing time ``alert_time``."""
    connections = F.col("connection_count")
    flood = (connections > rules.flood_connections) & (F.col("avg_duration") < rules.flood_duration)
    heavy = (F.col("bytes_per_connection") > rules.heavy_bytes) & (
        connections > rules.heavy_connections
    )
    level = F.when(flood, HIGH).when(heavy, MEDIUM).otherwise(LOW)
    reason = F.when(flood, REASONS[HIGH]).when(heavy, REASONS[MEDIUM]).otherwise(REASONS[LOW])
    return df.withColumns(
        {"alert_level": level, "alert_reason": reason, "alert_time": F.current_timestamp()}
    )


def score_stream(
    df: DataFrame, model: PipelineModel | str | None, rules: Rules = Rules()
) -> DataFrame:
    """Score with a fitted or saved pipeline; without one, apply the rules."""
    if model is None:
        return alert_rules(df, rules)
    fitted = PipelineModel.load(model) if isinstance(model, str) else model
    return fitted.transform(df)


def to_alert_json(df: DataFrame) -> DataFrame:
    """One JSON text per row, in the column ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_alerts(
    df: DataFrame,
    sink: str,
    checkpoint: str,
    available_now: bool = False,
    **options: str,
) -> StreamingQuery:
    """Append alerts to ``sink``: JSON lines for kafka and text, rows for the others.

    ``options`` are those of the sink, for instance ``topic``, ``path`` or
    ``queryName``.
    """
    rows = to_alert_json(df) if sink in ("kafka", "text") else df
    writer = rows.writeStream.outputMode("append").format(sink)
    name = options.pop("queryName", None)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.options(**options).option("checkpointLocation", checkpoint).start()


def start_alerts(
    df: DataFrame,
    sinks: dict[str, dict[str, str]],
    checkpoint_dir: str,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """One query per sink (name of the sink to its options), each with its own checkpoint."""
    return [
        write_alerts(df, sink, f"{checkpoint_dir}/{sink}", available_now, **options)
        for sink, options in sinks.items()
    ]


#: Writes one batch to one sink; called again with the same batch id after a failure.
BatchSink = Callable[[DataFrame, int], None]


def file_sink(kind: str, path: str) -> BatchSink:
    """Rows of a batch in a folder of its own, which a repeated batch replaces; read with ``read_batches``."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").format(kind).save(f"{path}/batch={number}")

    return write


def read_batches(df: DataFrame, kind: str, path: str) -> DataFrame:
    """All batches that a ``file_sink`` has written of the stream ``df``."""
    return df.sparkSession.read.format(kind).schema(df.schema).load(f"{path}/batch=*")


def write_to_all(
    df: DataFrame, sinks: Mapping[str, BatchSink], checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """One query, one state and one checkpoint for several sinks.

    Each batch is computed once and handed to every sink. If a sink fails, the batch is repeated for all of
    them under the same number after a restart: sinks that replace what they have of a batch, as ``file_sink``
    does, end with every row once.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks.values():
                sink(batch, number)
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode("append").foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()
