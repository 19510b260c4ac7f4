"""Shared storage through Hadoop's file systems, and a folder for what a session needs for a while."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, files = _path(spark, path)
    return files.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, files = _path(spark, path)
    files.delete(p, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``; a local session without it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="plinth-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
