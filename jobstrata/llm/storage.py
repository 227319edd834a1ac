"""The folder that driver and executors share, and intermediate tables kept in it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from jobstrata.session import checkpointed


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI below the checkpoint folder of the cluster."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        given = context.getConf().get("spark.checkpoint.dir")
        if given:
            context.setCheckpointDir(given)
        else:
            checkpointed(spark.range(1))  # sets a folder on a local master, or raises
    top = context.getCheckpointDir()
    return f"{top if ':' in top else 'file://' + top}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new shared folder and read back, its lineage cut."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
