import csv
import glob
from datetime import datetime, timezone

import pytest

from shelfmark import schema as S
from shelfmark.operators import merge
from shelfmark.plans.rescan import rescan
from shelfmark.sources import staging
from shelfmark.sources.store import Catalog, buckets_for, export_csv, with_files_schema

AT = datetime(2024, 1, 1, 3, tzinfo=timezone.utc)


def rows(spark, *given, schema=S.FILES):
    return spark.createDataFrame(
        [tuple(r.get(c) for c in schema.fieldNames()) for r in given], schema
    )


def test_empty_catalog(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    assert catalog.latest() is None
    assert catalog.files().count() == 0 and catalog.files().columns == S.FILE_COLUMNS
    assert catalog.runs().count() == 0 and catalog.runs().columns == S.RUN_COLUMNS


def test_commit_is_what_makes_a_snapshot_current(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    catalog.adopt(rows(spark, {"id": 4, "path": "/a"}), "one")
    catalog.write_snapshot(rows(spark, {"path": "/b"}), "died")
    assert [r["path"] for r in catalog.files().collect()] == ["/a"]
    assert catalog.latest()["last_id"] == 4
    with pytest.raises(Exception, match="(?i)already.exists"):
        catalog.write_snapshot(rows(spark, {"path": "/c"}), "died")


def test_adopt_refuses_a_path_in_two_rows(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    with pytest.raises(ValueError, match="2 rows: '/a'"):
        catalog.adopt(rows(spark, {"path": "/a"}, {"path": "/b"}, {"path": "/a"}), "one")
    assert catalog.latest() is None


def test_second_of_two_writers_fails(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    for run_id in ("one", "two"):
        catalog.write_snapshot(rows(spark, {"path": f"/{run_id}"}), run_id)
    catalog.commit({"run_id": "one", "seq": 1, "last_id": 0})
    with pytest.raises(RuntimeError, match="one.*two"):
        catalog.commit({"run_id": "two", "seq": 1, "last_id": 0})
    assert [r["path"] for r in catalog.files().collect()] == ["/one"]
    catalog.commit({"run_id": "two", "seq": 2, "last_id": 0})
    assert [r["path"] for r in catalog.files().collect()] == ["/two"]
    assert catalog.runs().count() == 2


def test_commit_after_a_writer_died_while_committing(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    (tmp_path / "cat" / "runs" / f"{1:012d}" / "_temporary").mkdir(parents=True)
    assert catalog.latest() is None
    catalog.commit({"run_id": "one", "seq": 1, "last_id": 0})
    assert catalog.latest()["run_id"] == "one"


def test_ledger_of_an_older_catalog_with_two_rows_of_a_number(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    for run_id, second in (("late", 9), ("early", 5)):
        spark.range(1).selectExpr(
            f"'{run_id}' AS run_id", f"timestamp_seconds({second}) AS finished_at", "1L AS seq"
        ).write.mode("append").parquet(f"{catalog.folder}/runs")
    assert catalog.latest()["run_id"] == "early"
    catalog.commit({"run_id": "next", "seq": 2, "last_id": 0})
    assert catalog.latest()["run_id"] == "next" and catalog.runs().count() == 3


def test_older_schema(spark, tmp_path):
    old_schema = S.T.StructType([f for f in S.FILES if f.name != "missing_since"])
    old = rows(spark, {"id": 9, "path": "/r/a.epub", "root": "/r", "run_id": "x"}, schema=old_schema)
    upgraded = with_files_schema(old)
    assert upgraded.schema == S.FILES
    assert with_files_schema(upgraded).schema == S.FILES
    assert upgraded.first()["missing_since"] is None
    # Adopted as a snapshot, the old rows take part in the next scan.
    library = tmp_path / "r"
    library.mkdir()
    (library / "b.epub").write_bytes(b"b")
    catalog = Catalog(spark, str(tmp_path / "cat"))
    root = str(library)
    catalog.adopt(old.selectExpr(
        "* EXCEPT (path, root)", f"'{root}/a.epub' AS path", f"'{root}' AS root"
    ), "from-v1")
    result = rescan(spark, catalog.folder, [root], log=lambda *_: None)
    assert (result["total_files"], result["missing"]) == (2, 1)
    assert {r["filename"]: r["id"] for r in catalog.files().where("id > 9").collect()} == {"b.epub": 10}


def test_csv_reads_back(spark, tmp_path):
    given = [
        {
            "id": i, "path": p, "root": "/r", "filename": p.rsplit("/", 1)[-1], "top_folder": "",
            "size_bytes": 0, "mtime": m, "rag_eligible": 1, "first_seen": AT, "last_seen": AT,
            "error": e,
        }
        for i, (p, m, e) in enumerate([
            ("/r/plain.txt", 1733000000.0, None),
            ('/r/quote".txt', 1733000000.125, 'hash: "bad", really'),
            ("/r/comma, and space .txt", 1700000000.123456, None),
            ("/r/back\\slash.txt", None, None),
            ("/r/ends with quote\"", 1.5, None),
            ("/r/line\nbreak.txt", 1.5, None),
            ("/r/ lead.txt ", 1.5, "  spaces kept  "),
        ])
    ]
    target = str(tmp_path / "csv")
    assert export_csv(rows(spark, *given), target) == len(given)
    read, parts = [], sorted(glob.glob(f"{target}/*.csv"))
    for part in parts:
        with open(part, newline="", encoding="utf-8") as f:
            lines = list(csv.reader(f))
        assert lines[0] == S.FILE_COLUMNS
        read += [dict(zip(S.FILE_COLUMNS, line)) for line in lines[1:]]
    expected = sorted(given, key=lambda r: r["path"].encode())
    assert [r["path"] for r in read] == [r["path"] for r in expected]
    for ours, want in zip(read, expected):
        assert ours["mtime"] == ("" if want["mtime"] is None else repr(want["mtime"]))
        assert ours["error"] == (want["error"] or "")
        assert ours["filename"] == want["filename"]
        assert ours["sha256"] == ours["top_folder"] == ours["missing_since"] == ""
        assert ours["first_seen"] == "2024-01-01T03:00:00+00:00"
        assert ours["size_bytes"] == "0"


def test_views(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    catalog.adopt(rows(
        spark, *[{"path": f"/r/{n}", "sha256": "h", "size_bytes": 3} for n in "abc"],
        {"path": "/r/d", "sha256": "other"},
    ), "one")
    catalog.create_views()
    got = spark.sql(
        "SELECT copies, size_bytes FROM duplicate_groups ORDER BY copies DESC"
    ).collect()
    assert [tuple(r) for r in got] == [(3, 3)]
    members = spark.sql("SELECT path FROM duplicate_members").collect()
    assert {r["path"] for r in members} == {"/r/a", "/r/b", "/r/c"}
    assert spark.sql("SELECT count(*) FROM files").first()[0] == 4
    assert spark.sql("SELECT note FROM runs").first()[0] == "adopted"
    assert [r["path"] for r in catalog.rows().collect()] == ["/r/a", "/r/b", "/r/c", "/r/d"]


def test_staging_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert staging.staging_dir(spark, "x", fallback="/not/used") == f"{named.rstrip('/')}/x"

    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

    assert staging.staging_dir(Session, "x", fallback="/shared/cat/") == "/shared/cat/x"
    with pytest.raises(ValueError):
        staging.staging_dir(Session, "x")


def listed(spark, paths):
    return spark.createDataFrame(
        [("/r", p, 1, 1.0, None, 1) for p in paths],
        "root string, path string, size_bytes long, mtime double, error string, visits long",
    )


@pytest.mark.parametrize("quoted", ["cat", "o'cat"])
def test_the_prior_snapshot_is_not_shuffled(spark, tmp_path, quoted):
    """Only the listing's few columns move, also when the catalog is opened anew."""
    folder = str(tmp_path / quoted)
    Catalog(spark, folder).adopt(rows(spark, *({"id": i, "path": f"/r/{i}"} for i in range(500))), "one")
    prior = Catalog(spark, folder).prior()
    joined = merge.matched(listed(spark, [f"/r/{i}" for i in range(250, 700)]), prior)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(path_hash") == 1 and "FullOuter" in plan
    shuffled = plan[plan.index("Exchange hashpartitioning(path_hash"):]
    assert "Scan ExistingRDD" in shuffled.split("FileScan")[0]  # the listing is below, the snapshot is not
    assert "Bucketed: true" in plan
    pairs = {r["path"]: (r["visits"], r["old_id"]) for r in joined.collect()}
    assert pairs == {f"/r/{i}": (1 if i >= 250 else None, i if i < 500 else None) for i in range(700)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("shelfmark_")]


def test_buckets_follow_rows_and_never_shrink(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert buckets_for(spark, 0) == buckets_for(spark, 4_000_000) == least
    assert buckets_for(spark, 9_000_001) == 10 and buckets_for(spark, 5, 64) == 64


def test_a_snapshot_of_an_older_version_takes_part(spark, tmp_path):
    """Written without buckets, and a ledger row without their number."""
    catalog = Catalog(spark, str(tmp_path / "cat"))
    rows(spark, {"id": 1, "path": "/r/1"}).write.parquet(catalog.snapshot_path("old"))
    catalog.commit({"run_id": "old", "seq": 1, "last_id": 1})
    found = merge.matched(listed(spark, ["/r/1", "/r/2"]), catalog.prior()).collect()
    assert {r["path"]: r["old_id"] for r in found} == {"/r/1": 1, "/r/2": None}
