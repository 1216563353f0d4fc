import hashlib
import os

from pyspark.sql import functions as F

from shelfmark.sources import content


def test_column_hash_and_cap(spark):
    df = spark.createDataFrame([("é",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(content.content_hash(F.col("t"))).collect()]
    assert got == [hashlib.sha256("é".encode()).hexdigest(), hashlib.sha256(b"").hexdigest(), None]
    # The cap counts bytes, and the cap itself still fits; 0 means no cap.
    capped = [r[0] is None for r in df.select(content.content_hash(F.col("t"), 1)).collect()]
    assert capped == [True, False, True]
    assert df.select(content.content_hash(F.col("t"), 0)).first()[0] == got[0]


def test_file_hashes_and_errors(spark, tmp_path):
    big = os.urandom(3 << 20)
    (tmp_path / "big").write_bytes(big)
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "folder").mkdir()
    os.mkfifo(tmp_path / "pipe")
    names = ["big", "empty", "folder", "pipe", "gone"]
    df = spark.createDataFrame(
        [(str(tmp_path / n), 1, f"tag {n}") for n in names], "path string, size_bytes long, tag string"
    )
    rows = {r["tag"][4:]: r for r in content.with_file_hashes(df).collect()}
    assert rows["big"]["new_sha256"] == hashlib.sha256(big).hexdigest()
    assert rows["empty"]["new_sha256"] == hashlib.sha256(b"").hexdigest()
    for n in ("folder", "pipe", "gone"):
        assert rows[n]["new_sha256"] is None and rows[n]["hash_error"].startswith("hash: ")
    assert rows["big"]["hash_error"] is None


def bytes_per_task(spark, df, task_bytes):
    spread = content.spread_by_bytes(df, task_bytes)
    cost = F.coalesce("size_bytes", F.lit(0)) + content.OPEN_COST
    return [
        r["b"] for r in
        spread.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(cost).alias("b")).collect()
    ]


def test_tasks_get_equal_bytes(spark):
    # A third of the files are empty, a few hold most of the bytes.
    df = spark.range(30_000).selectExpr(
        "concat('/f/', id) AS path",
        "CASE WHEN id % 3 = 0 THEN 0L WHEN id % 1000 = 1 THEN 4294967296L ELSE 1048576L END"
        " AS size_bytes",
    )
    target = 1 << 30
    loads = bytes_per_task(spark, df, target)
    assert sum(loads) == 30_000 * content.OPEN_COST + df.agg(F.sum("size_bytes")).first()[0]
    single_file = (4 << 30) + content.OPEN_COST
    assert max(loads) <= max(2 * target, 5 * single_file)
    # The empty files alone fill some thirty tasks, not one.
    assert len(loads) > 60


def test_task_count_is_bounded(spark):
    df = spark.range(1000).selectExpr("string(id) AS path", "1073741824L AS size_bytes")
    spread = content.spread_by_bytes(df, task_bytes=1 << 20, max_tasks=10)
    assert spread.rdd.getNumPartitions() <= 12
    assert spread.count() == 1000


def test_nothing_to_read(spark):
    df = spark.createDataFrame([], "path string, size_bytes long")
    assert content.with_file_hashes(df).count() == 0
