"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Where no folder is set, a session in one process (``local[...]``) gets a temporary one; on a
    cluster that is an error, because no executor could read what another one wrote.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rankloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/rankloom-{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete all that this application has stored; call it before the session ends."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a write's shuffle files go when it has ended, not when the driver collects its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the optimizer the real size,
    so that a small result is broadcast by size and a large one is not.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
