"""Intermediate tables in the cluster's shared folder.

A written table cuts lineage, survives the loss of executors and tells the
planner its real size, so later joins are planned from facts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one in the warehouse, which is shared too."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or context.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"


def removed_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder removed when the application ends."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table; it is removed when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    removed_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)
