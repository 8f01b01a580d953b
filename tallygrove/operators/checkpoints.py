"""Intermediate results that outlive executors, in the folder that all machines share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None


def _base(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, one of our own in local mode and an error on a cluster."""
    global _own
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if not base:
        base = _own = _own or f"file://{tempfile.mkdtemp(prefix='tallygrove-')}"
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all machines share."""
    return f"{_base(spark)}/tallygrove/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and cut from its lineage: a table in the folder that all machines share, removed when the driver ends.

    As a table it has a size, so joins with a small one are broadcast, and readers take the
    columns that they need.
    """
    spark = df.sparkSession
    path = shared_path(spark, "kept")
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended before
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
