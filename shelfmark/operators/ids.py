"""Surrogate ids for new rows: dense, unique, and the same on every re-run."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 65_536

# The first four hex digits of a path's MD5 give BUCKETS even shares of any paths.
BUCKET = "int(conv(substring(md5(path), 1, 4), 16, 10))"


def numbered(new: DataFrame, last_id: Column) -> DataFrame:
    """Give rows an ``id`` from ``last_id`` + 1 on, in (bucket, path) order.

    A global row_number would run in one task. Here every bucket numbers its own
    rows and starts where the buckets before it end. The table of starts has at
    most BUCKETS rows, a megabyte, whatever the data: that bounds the one window
    without partitions and the broadcast. ``new`` is read twice, so it should be
    a written table.
    """
    placed = new.selectExpr("*", f"{BUCKET} AS bucket")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("bucket").count().select(
        "bucket", (F.coalesce(F.sum("count").over(before), F.lit(0)) + last_id).alias("start")
    )
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("path"))
    return (
        placed.withColumn("rank", rank)
        .join(F.broadcast(starts), "bucket")
        .withColumn("id", (F.col("start") + F.col("rank")).cast("long"))
        .select(*new.columns)
    )
