"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a new one for a local master."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"{_SETTING} must name a folder that all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tillcast-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so that later jobs reuse it and lineage is cut.

    Unlike a cache, the written table survives the loss of executors.
    """
    path = new_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
