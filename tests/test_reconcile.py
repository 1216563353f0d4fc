"""Ledger matches against all pairs, book numbers, and a title that most rows share."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.isbn import isbn13
from shelfmark.operators import curation, reconcile

FILE = "path string, sha256 string, isbn string, author string, title string, corpus string"
ENTRY = "entry_id string, isbn string, author string, title string, corpus string"
ISBNS = ["9780306406157", "9783161484100", "9780000000002"]


@pytest.mark.parametrize("text, number", [
    ("ISBN 978-0-306-40615-7, 2nd", "9780306406157"),
    ("0-306-40615-2", "9780306406157"),
    ("0 8044 2957 x", "9780804429573"),
    ("080442957X", "9780804429573"),
    ("080442957Xy", None),
    ("978-0-306-40615-8 or 3161484107", None),
    ("978-0-306-40615-8 or 316148410X", "9783161484100"),
    ("12345978030640615712", None),
    ("", None),
    (None, None),
])
def test_isbn(spark, text, number):
    row = spark.createDataFrame([(text,)], "t string").select(F.expr(isbn13("t")).alias("n")).first()
    assert row["n"] == number


def brute(files, entries):
    """(file rows, entry rows) by comparing every file with every entry."""
    kinds = ("isbn", "author_title", "title")
    out, chosen = {}, {}
    for path, _, isbn, author, title, corpus in files:
        found = {k: [] for k in kinds}
        for e, (e_isbn, e_author, e_title, _) in entries.items():
            if isbn and isbn == e_isbn:
                found["isbn"].append(e)
            if title and title == e_title and author == e_author and author:
                found["author_title"].append(e)
            elif title and title == e_title and not (author and e_author):
                found["title"].append(e)
        if not author:
            found["title"] = [e for e, v in entries.items() if title and v[2] == title]
        kind = next((k for k in kinds if found[k]), None)
        chosen[path] = sorted(found[kind]) if kind else []
        status, differs, given = "disk_only", None, None
        if len(chosen[path]) > 1:
            status = "conflict"
        elif chosen[path]:
            e = entries[chosen[path][0]]
            pairs = (("isbn", isbn, e[0]), ("author", author, e[1]), ("title", title, e[2]),
                     ("corpus", corpus if corpus != "unassigned" else None, e[3]))
            differs = ",".join(f for f, a, b in pairs if a and b and a != b) or None
            status, given = ("mismatch" if differs else "matched"), e[3]
        out[path] = [kind, min(chosen[path], default=None), len(chosen[path]), differs, status, given]
    group = {e: {e} for e in entries}
    for es in chosen.values():
        merged = set().union(*(group[e] for e in es))
        for e in merged:
            group[e] = merged
    for row in out.values():
        row[3:3] = [min(group[row[1]]), len(group[row[1]])] if row[1] else [None, None]
    recorded = {}
    for e in entries:
        mine = [out[p][6] for p, es in chosen.items() if e in es]
        best = next((s for s in reconcile.STATUS if s in mine), "ledger_only")
        recorded[e] = (best, len(mine), min(group[e]), len(group[e]))
    return {p: tuple(r) for p, r in out.items()}, recorded


def prepared(spark, files):
    return spark.createDataFrame(files, FILE).withColumns({
        "author_key": curation.name_key("author"), "title_key": curation.name_key("title"),
        "keeper": F.lit(None).cast("string"), "missing_since": F.lit(None).cast("timestamp"),
        "rag_eligible": F.lit(1), "kind": F.lit("clash"), "entry_id": F.lit("clash"),
    })


def check(spark, files, entries, folder):
    sheet = spark.createDataFrame([(e, *v) for e, v in entries.items()], ENTRY)
    matches, recorded = reconcile.reconcile(prepared(spark, files), sheet, folder)
    ours = {r["path"]: (r["matched_by"], r["entry_id"], r["candidates"], r["group_id"], r["group_entries"],
                        r["differs"], r["status"], r["ledger_corpus"]) for r in matches.collect()}
    lines = {r["entry_id"]: (r["status"], r["files"], r["group_id"], r["group_entries"])
             for r in recorded.collect()}
    return ours, lines, matches, recorded


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    titles = ["rivers", "otters", "maps", "a tale", "clay", "wind", "salt", ""]

    def some(values, none):
        return rng.choice(values) if rng.random() > none else None

    files = [
        (f"/f{i}", f"h{i}", some(ISBNS, 0.8), rng.choice(["ann", "bob", "cy", ""]), rng.choice(titles) if i % 2
         else f"own {i % 30}", rng.choice(["unassigned", "fiction"])) for i in range(80)
    ]
    entries = {
        f"E{i}": (some(ISBNS, 0.8), rng.choice(["ann", "bob", ""]),
                  rng.choice(titles) if i % 3 == 0 else f"own {i}",
                  some(["fiction", "ghostwriting"], 0.2)) for i in range(40)
    }
    ours, lines, matches, recorded = check(spark, files, entries, f"test-ledger-{seed}")
    files_wanted, entries_wanted = brute(files, entries)
    assert ours == files_wanted
    assert lines == entries_wanted
    assert {r[6] for r in ours.values()} == {"matched", "mismatch", "conflict", "disk_only"}

    counts = {r["status"]: (r["files"], r["entries"]) for r in reconcile.report(matches, recorded).collect()}
    assert sum(f for f, _ in counts.values()) == 80 and sum(e for _, e in counts.values()) == 40
    assert counts["ledger_only"][0] == 0 and counts["disk_only"][1] == 0


def test_conflicts_are_grouped_through_shared_entries(spark):
    """x has the ISBN of a and b, y the title of b and c: all three have to be looked at together."""
    entries = {
        "a": (ISBNS[0], "", "one", None), "b": (ISBNS[0], "", "two", None), "c": (None, "", "two", "fiction"),
        "d": (None, "ann", "three", "fiction"),
    }
    files = [("/x", "1", ISBNS[0], "", "nine", "unassigned"), ("/y", "2", None, "", "two", "unassigned"),
             ("/z", "3", None, "ann", "three", "unassigned")]
    ours, lines, matches, _ = check(spark, files, entries, "test-ledger-groups")
    assert [ours[p][3:5] for p in ("/x", "/y", "/z")] == [("a", 3), ("a", 3), ("d", 1)]
    assert {e: v[2] for e, v in lines.items()} == {"a": "a", "b": "a", "c": "a", "d": "d"}
    assert [tuple(r) for r in reconcile.assignments(matches).collect()] == [("3", "fiction")]


def test_a_title_that_most_rows_share(spark):
    """2,000 files and 2,000 entries of one title are 4 million pairs, but rows stay per file."""
    files = [(f"/f{i}", None, None, "", "untitled", "unassigned") for i in range(2000)]
    entries = {f"E{i:04}": (None, "", "untitled", None) for i in range(2000)}
    ours, lines, _, _ = check(spark, files, entries, "test-ledger-hot")
    assert set(ours.values()) == {("title", "E0000", 2000, "E0000", 2000, None, "conflict", None)}
    assert set(lines.values()) == {("conflict", 2000, "E0000", 2000)}


def test_entries_without_id_or_in_several_rows(spark):
    sheet = spark.createDataFrame([
        (None, ISBNS[0], "ann", "x", None), ("e", None, "bob", "maps", "fiction"),
        ("e", None, "ann", "maps", "ghostwriting"), ("n", None, None, None, None),
    ], ENTRY)
    known = {r["entry_id"]: r["author"] for r in reconcile.ledger(sheet).collect()}
    assert known == {"e": "ann", "n": ""}
    files = [("/x", "1", ISBNS[0], "ann", "x", "unassigned")]
    matches, recorded = reconcile.reconcile(prepared(spark, files), sheet, "test-ledger-ids")
    assert [r["status"] for r in matches.collect()] == ["disk_only"]
    assert {r["entry_id"]: r["status"] for r in recorded.collect()} == {"e": "ledger_only", "n": "ledger_only"}


def test_empty_tables(spark):
    ours, lines, matches, recorded = check(spark, [], {}, "test-ledger-none")
    assert (ours, lines) == ({}, {}) and reconcile.report(matches, recorded).isEmpty()


def test_no_growing_table_goes_through_the_driver(spark, tmp_path, monkeypatch):
    """Tables small enough to be broadcast are joined as large ones are."""
    from shelfmark.operators import components as c
    plans = []

    def written(df, target):
        out = plain(df, target)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    plain = reconcile.written
    monkeypatch.setattr(reconcile, "written", written)
    monkeypatch.setattr(c, "written", written)
    files = [(f"/f{i}", f"s{i}", None, "a", f"t{i % 7}", "unassigned") for i in range(40)]
    entries = [(f"e{i}", None, "a", f"t{i % 5}", None) for i in range(10)]
    files = spark.createDataFrame(files, FILE).selectExpr(
        "*", "timestamp(NULL) AS missing_since", "1 AS rag_eligible", "path AS keeper", "'u' AS shelf",
        "author AS author_key", "title AS title_key",
    )
    matches, recorded = reconcile.reconcile(files, spark.createDataFrame(entries, ENTRY), "unsent")
    assert matches.count() == 40 and recorded.count() == 10
    joins = [p for p in plans if "Join" in p]
    assert len(joins) > 8 and not any("BroadcastHashJoin" in p for p in joins)
