"""Tables made of a few driver-side rows."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: str | StructType) -> DataFrame:
    """A local relation: known to the optimizer with its size, no Python tasks."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) or [() for _ in fields]
    kinds = to_arrow_schema(fields)
    arrays = [pa.array(list(c), kind.type) for c, kind in zip(columns, kinds)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=kinds.names), fields)
