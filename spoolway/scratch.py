"""Folders that every executor can reach."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local runs may do without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spoolway-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder for this application; it may be removed when the application has ended."""
    return f"{shared_dir(spark)}/spoolway/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read, and read it back."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
