"""Staged tables and joins against sides of checked size."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.staging import staging_dir, written

#: Rows of a side that may be broadcast, and bytes of its files; beyond, both sides are shuffled.
SMALL_ROWS, SMALL_BYTES = 500_000, 16 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below spark.checkpoint.dir and read it back: lineage ends there."""
    return written(df, staging_dir(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}"))


def small(df: DataFrame) -> DataFrame:
    """``df`` (a staged table) with a broadcast hint if it has few rows and bytes."""
    if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > SMALL_BYTES:
        return df
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
