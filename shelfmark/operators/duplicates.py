"""Files with equal content hashes, safe for hashes that hold much of the catalog.

All empty files share one hash, so a group can be as large as the catalog. Group
sizes come from partially aggregated counts, one row per hash; members, one row per
file, are joined to them, where AQE splits a hot hash.

AQE splits a hot key only where both inputs of a join come straight from the
join's own shuffles. The aggregated side is already partitioned by the key, so it
would get none; ``rebalance`` on that side, which is small, makes Spark add it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_sizes(files: DataFrame) -> DataFrame:
    """(sha256, size_bytes, copies) of every group of two or more."""
    return (
        files.where("sha256 IS NOT NULL")
        .groupBy("sha256")
        .agg(F.max("size_bytes").alias("size_bytes"), F.count("*").alias("copies"))
        .where("copies > 1")
    )


def members(files: DataFrame) -> DataFrame:
    """(sha256, size_bytes, copies, path), one row per file in a group."""
    paths = files.where("sha256 IS NOT NULL").select("sha256", "path")
    return paths.join(group_sizes(files).hint("rebalance"), "sha256").select(
        "sha256", "size_bytes", "copies", "path"
    )


def totals(files: DataFrame) -> DataFrame:
    """One row: number of groups and of files in them."""
    return group_sizes(files).agg(
        F.count("*").alias("duplicate_groups"),
        F.expr("coalesce(sum(copies), 0L) AS files_in_dup_groups"),
    )


def largest_first(grouped: DataFrame) -> DataFrame:
    return grouped.orderBy(F.desc("copies"), "sha256")


def moved(files: DataFrame, run_id: str) -> DataFrame:
    """Missing files whose content this run met at a new path.

    One row per missing file, with the number of new paths and the first of them.
    Pairing every old path with every new one would square a hot hash; reducing
    the new side to one row per hash first keeps the output linear.
    """
    is_new = (F.col("run_id") == run_id) & (F.col("first_seen") == F.col("last_seen"))
    arrived = (
        files.where(is_new & F.col("sha256").isNotNull())
        .groupBy("sha256")
        .agg(F.count("*").alias("new_copies"), F.min("path").alias("new_path"))
    )
    gone = files.where("missing_since IS NOT NULL AND sha256 IS NOT NULL").select(
        "sha256", F.col("path").alias("old_path")
    )
    found = gone.join(arrived.hint("rebalance"), "sha256")
    return found.select("sha256", "old_path", "new_copies", "new_path")
