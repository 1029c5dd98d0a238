"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Where spark.checkpoint.dir is unset a local session, as in tests, makes and sets a
    temporary folder.  Executors of a cluster don't share one, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="linkwright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts the lineage at a table that outlives any executor.  The shuffle files behind
    it are deleted at once, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path  # for drop()
    return out


def drop(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
