"""Listing and removing the engine's own folders, on whatever storage they are."""

from pyspark.sql import SparkSession


def _storage(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names_in(spark: SparkSession, place: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    storage, path = _storage(spark, place)
    if not storage.exists(path):
        return []
    return sorted(f.getPath().getName() for f in storage.listStatus(path) if f.isDirectory())


def is_complete(spark: SparkSession, place: str) -> bool:
    """Whether the job that wrote a table has finished."""
    storage, path = _storage(spark, f"{place}/_SUCCESS")
    return storage.exists(path)


def remove(spark: SparkSession, place: str) -> bool:
    """Remove a folder and all below it; whether it was there."""
    storage, path = _storage(spark, place)
    return storage.delete(path, True)
