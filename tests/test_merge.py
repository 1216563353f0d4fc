"""Row-level semantics of a rescan, on hand-made listings and prior snapshots."""

from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from shelfmark import schema as S
from shelfmark.operators import duplicates, ids, merge, reports, visits

THEN = datetime(2024, 1, 1, tzinfo=timezone.utc)
LATER = datetime(2024, 1, 2, tzinfo=timezone.utc)
RUN = merge.Run("now", datetime(2024, 2, 1, tzinfo=timezone.utc), ("/r",))
NOW = RUN.now


def prior(spark, *rows):
    base = dict.fromkeys(S.FILE_COLUMNS) | {
        "root": "/r", "rel_path": "old", "top_folder": "old", "filename": "old", "ext": "old",
        "fmt": "old", "category": "old", "rag_eligible": 1, "size_bytes": 1, "mtime": 1.5,
        "sha256": "h", "corpus": "unassigned", "corpus_hint": "old", "run_id": "before",
        "first_seen": THEN, "last_seen": THEN,
    }
    filled = [base | {"id": i + 1} | r for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c] for c in S.FILE_COLUMNS) for r in filled], S.FILES)


def listing(spark, *rows):
    base = {"root_ordinal": 0, "root": "/r", "size_bytes": 1, "mtime": 1.5, "error": None}
    names = S.ENTRIES.fieldNames()
    return spark.createDataFrame([tuple((base | r)[c] for c in names) for r in rows], S.ENTRIES)


def rescan(spark, entries, old, run=RUN, hashes="new"):
    """Snapshot after the run by path; every content read hashes to ``hashes``."""
    plan = merge.planned(
        merge.matched(visits.one_row_per_path(entries, visits.roots_overlap(run.roots)), old), run
    ).selectExpr("*", f"'{hashes}' AS new_sha256", "string(NULL) AS hash_error")
    files = merge.merged(plan, run)
    return {r["path"]: r for r in files.collect()}, plan, files


def test_unchanged_file_keeps_hash_and_identity(spark):
    rows, _, _ = rescan(
        spark, listing(spark, {"path": "/r/a/x.epub"}),
        prior(spark, {"path": "/r/a/x.epub", "id": 7, "error": "hash: was locked"}),
    )
    row = rows["/r/a/x.epub"]
    assert (row["id"], row["sha256"], row["hashed_now"]) == (7, "h", False)
    assert (row["rel_path"], row["top_folder"], row["fmt"]) == ("a/x.epub", "a", "epub")
    assert row["first_seen"] == THEN.replace(tzinfo=None)
    assert row["last_seen"] == NOW.replace(tzinfo=None)
    assert (row["run_id"], row["error"]) == ("now", None)


@pytest.mark.parametrize("change", [
    {"size_bytes": 2}, {"mtime": 1.5000001}, {"old": {"sha256": None}}, {"old": {"mtime": None}},
    {"old": {"size_bytes": None}},
])
def test_any_difference_means_hashing(spark, change):
    old = change.pop("old", {})
    rows, _, _ = rescan(
        spark, listing(spark, {"path": "/r/x.epub"} | change),
        prior(spark, {"path": "/r/x.epub"} | old),
    )
    assert (rows["/r/x.epub"]["sha256"], rows["/r/x.epub"]["hashed_now"]) == ("new", True)


def test_sidecars_and_stat_errors_are_never_hashed(spark):
    gone = {"size_bytes": None, "mtime": None, "error": "stat: gone"}
    rows, plan, files = rescan(
        spark,
        listing(spark, {"path": "/r/x.jpg"}, {"path": "/r/x.epub"} | gone),
        prior(spark, {"path": "/r/x.jpg"}, {"path": "/r/x.epub"}),
    )
    assert rows["/r/x.jpg"]["sha256"] is None
    assert rows["/r/x.epub"]["sha256"] is None and rows["/r/x.epub"]["error"] == "stat: gone"
    assert {r["action"] for r in plan.collect()} == {"skip"}
    counters = merge.run_counters(files, RUN).first().asDict()
    assert counters == {"files_seen": 2, "files_hashed": 0, "bytes_total": 1, "errors": 1}


def test_rehash_and_cap(spark):
    entries = listing(spark, {"path": "/r/x.epub", "size_bytes": 10}, {"path": "/r/y.epub", "size_bytes": 10})
    old = prior(spark, {"path": "/r/x.epub", "size_bytes": 10})
    capped, _, _ = rescan(spark, entries, old, replace(RUN, hash_cap=9))
    # A stored hash is reused whatever the cap; an over-cap file has none and no error.
    assert capped["/r/x.epub"]["sha256"] == "h"
    assert (capped["/r/y.epub"]["sha256"], capped["/r/y.epub"]["error"]) == (None, None)
    both, _, _ = rescan(spark, entries, old, replace(RUN, hash_cap=9, rehash=True))
    assert both["/r/x.epub"]["sha256"] is None
    again, _, _ = rescan(spark, entries, old, replace(RUN, rehash=True))
    assert again["/r/x.epub"]["sha256"] == "new"
    for cap in (0, -1, None, 10):
        rows, _, _ = rescan(spark, entries, old, replace(RUN, hash_cap=cap))
        assert rows["/r/y.epub"]["sha256"] == "new"


def test_scan_without_hashing(spark):
    entries = listing(spark, {"path": "/r/x.epub"}, {"path": "/r/y.epub", "size_bytes": 9})
    old = prior(spark, {"path": "/r/x.epub"}, {"path": "/r/y.epub"})
    kept, _, _ = rescan(spark, entries, old, replace(RUN, hashing=False))
    assert (kept["/r/x.epub"]["sha256"], kept["/r/y.epub"]["sha256"]) == ("h", None)
    erased, _, _ = rescan(spark, entries, old, replace(RUN, hashing=False, no_hash_policy="erase"))
    assert erased["/r/x.epub"]["sha256"] is None


def test_corpus_policies(spark):
    entries = listing(spark, {"path": "/r/x.epub"}, {"path": "/r/y.epub"}, {"path": "/r/z.epub"})
    old = prior(spark, {"path": "/r/x.epub", "corpus": "fiction"}, {"path": "/r/y.epub", "corpus": None})
    kept, _, _ = rescan(spark, entries, old)
    assert [kept[f"/r/{n}.epub"]["corpus"] for n in "xyz"] == ["fiction", "unassigned", "unassigned"]
    reset, _, _ = rescan(spark, entries, old, replace(RUN, corpus_policy="reset"))
    assert reset["/r/x.epub"]["corpus"] == "unassigned"
    with pytest.raises(ValueError):
        replace(RUN, corpus_policy="drop")
    for wrong in ({"no_hash_policy": "drop"}, {"run_id": "it's"}, {"run_id": ""}):
        with pytest.raises(ValueError):
            replace(RUN, **wrong)


def missing_case(spark):
    entries = listing(spark, {"path": "/r/seen.epub"})
    old = prior(
        spark, {"path": "/r/seen.epub", "missing_since": LATER},
        {"path": "/r/gone.epub"}, {"path": "/r/long-gone.epub", "missing_since": LATER},
        {"path": "/r/sub/nested.epub", "root": "/r/sub"}, {"path": "/q/other.epub", "root": "/q"},
        {"path": "/r/no-run.epub", "run_id": None}, {"path": "/r/this-run.epub", "run_id": "now"},
    )
    return entries, old


def test_missing_rows(spark):
    rows, plan, _ = rescan(spark, *missing_case(spark))
    since = {p.removeprefix("/r/"): r["missing_since"] for p, r in rows.items()}
    assert since == {
        "seen.epub": None, "gone.epub": NOW.replace(tzinfo=None),
        "long-gone.epub": LATER.replace(tzinfo=None), "sub/nested.epub": None,
        "/q/other.epub": None, "no-run.epub": None, "this-run.epub": None,
    }
    assert merge.missing_counts(plan).first().asDict() == {"missing": 2, "newly_missing": 1}
    changes = {r["path"]: r["change"] for r in plan.collect()}
    assert changes["/r/gone.epub"] == changes["/r/long-gone.epub"] == "missing"
    assert changes["/q/other.epub"] == changes["/r/sub/nested.epub"] == "carried"
    # A row that is carried over stays exactly as it was.
    assert rows["/q/other.epub"]["fmt"] == "old" and rows["/q/other.epub"]["run_id"] == "before"
    assert rows["/q/other.epub"]["last_seen"] == THEN.replace(tzinfo=None)


def test_prune_deletes_flagged_rows_too(spark):
    rows, _, _ = rescan(spark, *missing_case(spark), replace(RUN, prune=True))
    assert "/r/gone.epub" not in rows and "/r/long-gone.epub" not in rows
    assert len(rows) == 5


def test_partial_scan_and_no_roots_flag_nothing(spark):
    for run in (replace(RUN, partial=True, prune=True), replace(RUN, roots=(), prune=True)):
        rows, plan, _ = rescan(spark, *missing_case(spark), run)
        assert len(rows) == 7 and rows["/r/gone.epub"]["missing_since"] is None
        assert merge.missing_counts(plan).first()["missing"] == 0


def test_null_first_seen_stays_null(spark):
    rows, _, _ = rescan(
        spark, listing(spark, {"path": "/r/x.epub"}), prior(spark, {"path": "/r/x.epub", "first_seen": None})
    )
    assert rows["/r/x.epub"]["first_seen"] is None


def test_roots_with_quotes(spark):
    root = "/it's \\ \"odd\""
    rows, _, _ = rescan(
        spark, listing(spark, {"path": f"{root}/x.epub", "root": root}),
        prior(spark, {"path": f"{root}/gone.epub", "root": root}), replace(RUN, roots=(root,)),
    )
    assert rows[f"{root}/x.epub"]["rel_path"] == "x.epub"
    assert rows[f"{root}/gone.epub"]["missing_since"] is not None


def test_overlapping_roots_count_visits(spark):
    twice = listing(
        spark, {"path": "/r/s/x.epub", "size_bytes": 5},
        {"path": "/r/s/x.epub", "size_bytes": 5, "root": "/r/s", "root_ordinal": 1},
        {"path": "/r/y.epub", "size_bytes": 2},
    )
    run = replace(RUN, roots=("/r", "/r/s"))
    rows, _, files = rescan(spark, twice, prior(spark), run)
    assert (rows["/r/s/x.epub"]["root"], rows["/r/s/x.epub"]["rel_path"]) == ("/r/s", "x.epub")
    expected = {"files_seen": 3, "files_hashed": 2, "bytes_total": 12, "errors": 0}
    assert merge.run_counters(files, run).first().asDict() == expected
    # With rehash the second visit reads the content again.
    again = replace(run, rehash=True)
    _, _, files = rescan(spark, twice, prior(spark), again)
    assert merge.run_counters(files, again).first()["files_hashed"] == 3


def test_ids_are_dense_and_repeatable(spark):
    new = spark.range(20_000).selectExpr("concat('/p/', id) AS path", "bigint(NULL) AS id", "id % 7 AS x")
    ones = ids.numbered(new, F.lit(100))
    got = {r["path"]: r["id"] for r in ones.collect()}
    assert sorted(got.values()) == list(range(101, 20_101))
    assert got == {r["path"]: r["id"] for r in ids.numbered(new.repartition(5), F.lit(100)).collect()}
    assert ones.columns == new.columns


def test_summary_of_an_empty_catalog(spark):
    empty = spark.createDataFrame([], S.FILES)
    assert {(r["metric"], r["value"]) for r in reports.summary(empty).collect()} == {
        ("total_files", 0), ("rag_eligible", 0), ("total_bytes", 0), ("duplicate_groups", 0),
        ("files_in_dup_groups", 0),
    }
    counters = merge.run_counters(
        empty.selectExpr("*", "0L AS visits", "false AS hashed_now"), RUN
    ).first().asDict()
    assert set(counters.values()) == {0}


def test_summary_counts_missing_rows_unless_told_otherwise(spark):
    files = prior(
        spark, {"path": "/r/a"}, {"path": "/r/b", "missing_since": LATER},
        {"path": "/r/c", "sha256": None, "size_bytes": None},
    )
    def figures(df):
        return {r["metric"]: r["value"] for r in df.collect() if not r["key"]}
    assert figures(reports.summary(files)) == {
        "total_files": 3, "rag_eligible": 3, "total_bytes": 2, "duplicate_groups": 1,
        "files_in_dup_groups": 2,
    }
    assert figures(reports.summary(files, present_only=True))["duplicate_groups"] == 0
    assert reports.eligible_files(files).count() == 3


def test_duplicate_group_order_and_size(spark):
    files = prior(
        spark, *[{"path": f"/r/{n}", "sha256": "b", "size_bytes": s} for n, s in (("z", 1), ("a", 3))],
        *[{"path": f"/r/{n}", "sha256": "a"} for n in "pqr"],
        *[{"path": f"/r/{n}", "sha256": "c"} for n in "uv"], {"path": "/r/single", "sha256": "d"},
    )
    top = duplicates.largest_first(duplicates.group_sizes(files)).collect()
    assert [(r["sha256"], r["copies"], r["size_bytes"]) for r in top] == [
        ("a", 3, 1), ("b", 2, 3), ("c", 2, 1),
    ]


def test_moved_files(spark):
    new = {"run_id": "now", "first_seen": NOW, "last_seen": NOW}
    gone = {"missing_since": NOW}
    files = prior(
        spark, {"path": "/r/old1", "sha256": "m"} | gone, {"path": "/r/old2", "sha256": "m"} | gone,
        {"path": "/r/new2", "sha256": "m"} | new, {"path": "/r/new1", "sha256": "m"} | new,
        {"path": "/r/lost", "sha256": "n"} | gone, {"path": "/r/unhashed", "sha256": None} | gone,
        {"path": "/r/blank", "sha256": None} | new, {"path": "/r/stayed", "sha256": "n"},
    )
    rows = sorted(tuple(r) for r in duplicates.moved(files, "now").collect())
    assert rows == [("m", "/r/old1", 2, "/r/new1"), ("m", "/r/old2", 2, "/r/new1")]
