"""Where jobs write the tables that cut their lineage."""

from pyspark.sql import DataFrame, SparkSession


def staging_dir(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """A folder for one job, below the shared folder in ``spark.checkpoint.dir``.

    ``fallback`` serves where the session names none; it must be on storage that
    every executor reaches, such as the catalog's own folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{name}"


def unsent(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast.

    A table that grows with the catalog is small enough for it at some size, and then goes
    through the driver once a join.
    """
    return df.hint("merge")


def written(df: DataFrame, target: str) -> DataFrame:
    """Write ``df`` as a table and go on from there; survives lost executors."""
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
