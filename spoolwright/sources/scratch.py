"""Folders that the driver and all executors see, for tables between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder below spark.checkpoint.dir; a local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}"
    return f"{root.rstrip('/')}/spoolwright-{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written to a scratch folder and read again: computed once, with its lineage cut and its size known. The folder goes when the driver ends."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return df.sparkSession.read.schema(df.schema).parquet(path)
