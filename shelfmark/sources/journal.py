"""Hash results kept as they come, so a scan that dies leaves them to the next one.

Hashing goes in waves of bounded bytes. Each wave is a table of its own below the number
of the commit that the scan works towards; nothing is ever changed there. The next scan
works towards the same number if this one dies, finds the waves, and takes a hash over
where path, size and mtime are still the same. Once a commit has that number, the catalog
itself holds the hashes, and the waves are not looked at again.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "path string, size_bytes long, mtime double, new_sha256 string, hashed_at timestamp"


class Journal:
    """Waves of the scans that work towards commit ``seq`` of the catalog in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, seq: int):
        self.spark = spark
        self.place = f"{folder.rstrip('/')}/hashes/{seq:012d}"

    def append(self, hashed: DataFrame, scan: str, wave: int) -> DataFrame:
        """Write a wave (rows of the plan with ``new_sha256`` and ``hash_error``); the rows as stored."""
        target = f"{self.place}/{scan}-{wave:06d}"
        stamped = hashed.withColumn("hashed_at", F.current_timestamp())
        stamped.write.mode("errorifexists").parquet(target)
        return self.spark.read.schema(stamped.schema).parquet(target).drop("hashed_at")

    def known(self) -> DataFrame | None:
        """One row for each path hashed without error: ``path``, ``journaled`` (the latest
        size, mtime and hash). None without any wave."""
        try:
            rows = self.spark.read.schema(ROWS).parquet(f"{self.place}/*")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows.where("new_sha256 IS NOT NULL").groupBy("path").agg(
            F.max_by(F.struct("size_bytes", "mtime", "new_sha256"), "hashed_at").alias("journaled")
        )


def resumed(plan: DataFrame, known: DataFrame) -> DataFrame:
    """``plan`` in which rows to hash whose signature is in the journal have its hash and the
    action ``resume``. Both sides are unique by path, so no row is multiplied."""
    same = """action = 'hash' AND journaled IS NOT NULL
        AND size_bytes <=> journaled.size_bytes AND mtime <=> journaled.mtime"""
    values = {"sha256": "journaled.new_sha256", "action": "'resume'"}
    return plan.join(known, "path", "left").withColumn("same", F.expr(f"coalesce({same}, false)")).selectExpr(
        *[f"if(same, {values[c]}, {c}) AS {c}" if c in values else c for c in plan.columns]
    )
