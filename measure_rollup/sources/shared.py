"""Scratch data that every executor can reach.

On a cluster the folder is the one named by ``spark.checkpoint.dir``. Only a local
session that names none gets a temporary folder of its own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path, not yet existing, for one run's scratch files."""
    return f"{_root(spark)}/measure-rollup-{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder, so that later jobs do not redo it.

    The data is written reliably, so it survives the loss of executors.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_root(spark))
    return df.checkpoint()


def files_of(spark: SparkSession, path: str) -> tuple:
    """Hadoop's class of paths, and the file system that ``path`` is in."""
    jvm = spark.sparkContext._jvm
    of = jvm.org.apache.hadoop.fs.Path
    return of, of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _root(spark: SparkSession) -> str:
    context = spark.sparkContext
    configured = context.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):  # local-cluster[..] has executors of its own
        raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="measure-rollup-")
    context.setCheckpointDir(root)
    return root
