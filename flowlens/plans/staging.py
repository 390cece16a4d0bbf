"""Written intermediate tables, for results that must not be computed twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a scratch one only in local mode."""
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    folder = _local_folders.get(context.applicationId)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="flowlens-")
        _local_folders[context.applicationId] = folder
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder name under the shared folder that nothing has used yet."""
    return f"{work_dir(spark)}/flowlens/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    The copy is columnar, so later passes read only the columns they use, and
    it survives the loss of any executor.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
