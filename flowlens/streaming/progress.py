"""What a stream dropped as late, read from its own progress reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EPOCH = "1970-01-01T00:00:00.000Z"


def watermarks(query: StreamingQuery) -> dict[int, str]:
    """The watermark each batch with input rows ran under, by batch number."""
    return {
        p["batchId"]: p.get("eventTime", {}).get("watermark", EPOCH)
        for p in query.recentProgress
        if p["numInputRows"] > 0
    }


def dropped(query: StreamingQuery) -> int:
    """Rows, or partial sums of rows of one key, that the stateful operators of a query threw away."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def late_rows(batch: DataFrame, ts: str, size: str, watermark: str) -> DataFrame:
    """Rows of a batch whose tumbling window was closed by the ``watermark`` the batch ran under."""
    closed = F.to_timestamp(F.lit(watermark))
    return batch.where(F.window(ts, size).getField("end") <= closed) if watermark != EPOCH else batch.where(F.lit(False))
