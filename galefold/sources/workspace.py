"""Folders for tables that a plan writes before it reads them again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What the driver and all executors share: ``spark.checkpoint.dir``; without one, a folder of this machine for a local master only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: it must name a folder that the driver and all executors share")
        named = f"{tempfile.gettempdir()}/galefold-{spark.sparkContext.applicationId}"
    return named.rstrip("/")


def fresh_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/galefold-{tag}-{uuid.uuid4().hex}"


def path_and_files(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
