"""Shared folders for tables that a job writes and reads again."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme where the default file system is not local.

    Tasks that write files from Python do not know Spark's default file system.
    """
    if "://" in path or path.startswith("file:"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return path if default.startswith("file:") else default.rstrip("/") + path


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme, for tasks that open files from Python."""
    named = qualified(spark, path)
    return named if "://" in named or named.startswith("file:") else "file://" + os.path.abspath(named)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of the machine.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="vecsink-")
    return f"{qualified(spark, base).rstrip('/')}/{name}-{uuid.uuid4().hex}"
