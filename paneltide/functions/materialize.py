"""Writing an intermediate result once, where it is read several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for shared data.

    Only a session on one machine may do without; it uses a folder below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one; it goes when the session ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _forget_at_end(spark, folder)
    return folder


def _forget_at_end(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder now; their lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
        _forget_at_end(df.sparkSession, context.getCheckpointDir())
    return df.checkpoint(eager=True)
