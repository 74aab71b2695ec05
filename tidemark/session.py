"""What a session needs to run this package's Python functions."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it; on a cluster it is installed or shipped beside."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only where that setting is absent, as in local tests, a temporary folder of this machine serves, and only with a local master."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def run_folder(spark: SparkSession) -> str:
    """The folder of this application in the shared folder: all scratch tables lie in it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "tidemark-scratch")
    return f"{base.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of any file system that Spark knows, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, read back: it is computed once, and lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> None:
    """Deletes what is left of this application's scratch tables; to be called when no result is read any more."""
    remove(spark, run_folder(spark))
