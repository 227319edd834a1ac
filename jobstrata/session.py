"""Session settings and the two ways this library cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings one."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("jobstrata")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only a local master without that setting gets
    a folder of its own, since a cluster's executors could not read it and a lost one would
    take its share of the rows along.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can read")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="jobstrata-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back with its lineage cut."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """The same as a Parquet table: its size is known to the planner of later joins, and
    ``schema`` may read a column as another type of the same layout."""
    path = f"{checkpoint_folder(df.sparkSession)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)
