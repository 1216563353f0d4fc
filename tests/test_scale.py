"""Hot groups: one hash, one folder or one root that holds a third of all rows."""

import re

import pytest

from shelfmark.operators import duplicates, ids

N = 60_000


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    """A third of the files share one hash; another third comes in pairs."""
    target = str(tmp_path_factory.mktemp("skew") / "files")
    spark.range(N).selectExpr(
        "concat('/r/', id % 100, '/', id, '.epub') AS path",
        """CASE WHEN id % 3 = 0 THEN sha2('', 256)
                WHEN id % 3 = 1 THEN sha2(string(int(id / 6)), 256)
                ELSE sha2(concat('own', id), 256) END AS sha256""",
        "if(id % 3 = 0, 0L, id) AS size_bytes",
        "if(id % 2 = 0, 'now', 'before') AS run_id",
        "timestamp_seconds(if(id % 2 = 0, 2, 1)) AS first_seen",
        "timestamp_seconds(2) AS last_seen",
        "if(id % 2 = 0, NULL, timestamp_seconds(2)) AS missing_since",
    ).repartition(16).write.parquet(target)
    return spark.read.parquet(target)


@pytest.fixture
def small_partitions(spark):
    """Thresholds of runtime skew handling at the size of this test's data."""
    wanted = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    """The plan after it ran; the same DataFrame must have been collected."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_group_is_one_row_and_its_members_are_whole(catalog):
    rows = duplicates.group_sizes(catalog).collect()
    assert len({r["sha256"] for r in rows}) == len(rows)
    assert sorted({r["copies"] for r in rows}) == [2, N // 3]
    assert len(rows) == duplicates.totals(catalog).first()["duplicate_groups"]


def test_the_join_splits_a_hot_hash(catalog, small_partitions):
    listed = duplicates.members(catalog)
    assert len(listed.collect()) == N // 3 + N // 3
    assert "SortMergeJoin(skew=true)" in final_plan(listed)


def test_counts_are_reduced_before_the_shuffle(catalog):
    plan = final_plan(duplicates.totals(catalog))
    first = plan.rindex("partial_count(1)")
    exchange = plan.rindex("Exchange hashpartitioning(sha256")
    assert first > exchange  # printed deeper in the tree, so it runs earlier
    totals = duplicates.totals(catalog).first()
    assert totals["files_in_dup_groups"] == N // 3 + N // 3
    assert totals["duplicate_groups"] == 1 + N // 6


def test_moved_files_stay_linear(catalog, small_partitions):
    df = duplicates.moved(catalog, "now")
    rows = df.collect()
    hot = [r for r in rows if r["new_copies"] == N // 6]
    assert len(hot) == N // 6  # one row per missing file, not one per pair
    assert len({r["old_path"] for r in rows}) == len(rows)
    assert "SortMergeJoin(skew=true)" in final_plan(df)


def test_id_buckets_are_even(catalog):
    buckets = catalog.selectExpr(f"{ids.BUCKET} AS b").groupBy("b").count()
    low, high, used, most = buckets.selectExpr("min(b)", "max(b)", "count(*)", "max(count)").first()
    assert 0 <= low and high < ids.BUCKETS
    assert used > N / 2 and most < 15


def test_new_ids_broadcast_only_the_bucket_table(spark, catalog):
    from pyspark.sql import functions as F

    df = ids.numbered(catalog.selectExpr("path", "bigint(NULL) AS id"), F.lit(0))
    plan = final_plan(df)
    assert plan.count("BroadcastExchange") == 1
    below = plan[plan.index("BroadcastExchange"):]
    assert re.search(r"HashAggregate\(keys=\[bucket#\d+\], functions=\[count\(1\)\]", below)
