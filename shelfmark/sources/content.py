"""Content hashes: of bytes in a column, and of files read by tasks."""

import hashlib
import math
import os
import stat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN_COST = 1 << 20
TASK_BYTES = 1 << 30
MAX_TASKS = 200_000


def content_hash(content: Column, cap: int | None = None) -> Column:
    """SHA-256 in hex of a text or binary column; NULL above ``cap`` bytes."""
    digest = F.sha2(content, 256)
    if cap and cap > 0:
        return F.when(F.octet_length(content) <= cap, digest)
    return digest


def spread_by_bytes(
    files: DataFrame, task_bytes: int = TASK_BYTES, max_tasks: int = MAX_TASKS
) -> DataFrame:
    """Partition files so that every task reads about as many bytes.

    A file costs its size plus a fixed price for opening it, so that neither a
    few huge files nor a mass of empty ones pile up in a task. Files are put in
    classes of costs within a factor of two; each class gets tasks for its share
    of the bytes, and path hashes fill these evenly. The driver only sees one sum
    per class, at most 64 rows.
    """
    cost = F.coalesce("size_bytes", F.lit(0)) + OPEN_COST
    level = F.floor(F.log2(cost.cast("double"))).cast("int")
    sums = {
        r["level"]: (r["bytes"], r["n"])
        for r in files.groupBy(level.alias("level"))
        .agg(F.sum(cost).alias("bytes"), F.count("*").alias("n")).collect()
    }
    total = sum(b for b, _ in sums.values())
    share = max(task_bytes, math.ceil(total / max_tasks))
    bins = {k: min(n, math.ceil(b / share)) for k, (b, n) in sums.items()}
    start, task = 0, None
    for k in sorted(bins):
        within = F.pmod(F.xxhash64("path"), F.lit(bins[k])).cast("int") + start
        task = F.when(level == k, within) if task is None else task.when(level == k, within)
        start += bins[k]
    if task is None:
        return files
    return files.withColumn("task", task).repartitionById(start, F.col("task")).drop("task")


def _hasher():
    """The function a hashing task runs; self-contained, so executors need no package."""

    def one(path):
        try:
            # Opening a pipe would wait for a writer forever.
            if not stat.S_ISREG(os.stat(path).st_mode):
                return None, f"hash: not a regular file: '{path}'"
            with open(path, "rb") as content:
                return hashlib.file_digest(content, "sha256").hexdigest(), None
        except OSError as problem:
            return None, f"hash: {problem}"

    def run(batches):
        for batch in batches:
            results = [one(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array([r[i] for r in results], pa.string()) for i in (0, 1)],
                names=batch.schema.names + ["new_sha256", "hash_error"],
            )

    return run


def with_file_hashes(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Add ``new_sha256`` and ``hash_error`` by reading each row's ``path``.

    Files are read in chunks, never as a whole row. A file that cannot be read
    gets an error text; the job goes on. All other columns pass through, so the
    result needs no join back.
    """
    result = T.StructType(files.schema.fields + [
        T.StructField("new_sha256", T.StringType()), T.StructField("hash_error", T.StringType()),
    ])
    return spread_by_bytes(files, task_bytes).mapInArrow(_hasher(), result)
