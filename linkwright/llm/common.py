"""Shared pieces of the training-data operators: staging, Arrow scans, table access."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.sources.staging import drop, stage, work_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def release() -> None:
    """Give memory that numpy has freed back to the system, as workers live on; nothing where the C library can't."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def documents(docs: DataFrame) -> DataFrame:
    """doc_id and text only, so that no other column can clash with ours."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def checksum(df: DataFrame, *columns: str) -> tuple[int, int]:
    """Row count and an order-free sum of row hashes, to tell whether a table changed."""
    row = df.agg(F.count("*").alias("n"), F.sum((F.xxhash64(*columns) / F.lit(1 << 32)).cast("long")).alias("s")).first()
    return row["n"], row["s"] or 0
