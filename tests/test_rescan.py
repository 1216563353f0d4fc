"""End-to-end scans of a small real tree."""

from datetime import datetime, timedelta, timezone

import pytest

from shelfmark.plans.rescan import rescan
from shelfmark.sources.store import Catalog

TWIN = b"the same bytes twice"


def build(base):
    """One file per category, and two equal ones."""
    content = {
        "Nonfiction/otters.mobi": TWIN,
        "Fiction/otters (copy).mobi": TWIN,
        "Nonfiction/rivers.epub": b"a book on rivers",
        "AudioBooks/talk.mp3": b"not really sound",
        "ComicBookPDFs/strip.cbz": b"not really pictures",
        "Nonfiction/front.jpg": b"sidecar",
    }
    for rel, data in content.items():
        place = base / rel
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes(data)
    return base


@pytest.fixture
def library(tmp_path):
    return build(tmp_path / "library")


@pytest.fixture
def scan(spark, tmp_path, library):
    clock = [datetime(2024, 3, 1, 3, tzinfo=timezone.utc)]

    def run(**settings):
        clock[0] += timedelta(days=7)
        settings = {"roots": [str(library)], "now": clock[0], "log": lambda *_: None} | settings
        return rescan(spark, str(tmp_path / "catalog"), **settings)

    run.catalog = Catalog(spark, str(tmp_path / "catalog"))
    return run


def by_name(scan):
    return {r["filename"]: r for r in scan.catalog.files().collect()}


def test_full_scan(scan, tmp_path):
    result = scan(csv=str(tmp_path / "csv"))
    assert result["total_files"] == 6
    assert result["rag_eligible"] == 3
    assert result["duplicate_groups"] == 1
    assert result["files_in_dup_groups"] == 2
    assert result["by_category"]["audio"] == 1
    assert result["by_category"]["ebook_image"] == 1
    assert result["files_hashed_this_run"] == 5
    assert result["csv_rows"] == 6
    assert list((tmp_path / "csv").glob("*.csv"))
    assert sorted(r["id"] for r in scan.catalog.files().collect()) == [1, 2, 3, 4, 5, 6]


def test_unchanged_rescan_hashes_nothing(scan):
    first, second = scan(), scan()
    assert first["files_hashed_this_run"] == 5
    assert second["files_hashed_this_run"] == 0
    assert second["total_files"] == first["total_files"]
    assert second["total_bytes"] == first["total_bytes"]
    assert second["duplicate_groups"] == 1


def test_corpus_waits_and_hint_is_filled(scan):
    scan()
    rows = by_name(scan)
    assert {r["corpus"] for r in rows.values()} == {"unassigned"}
    assert rows["rivers.epub"]["corpus_hint"] == "trusted-nonfiction"
    assert rows["otters (copy).mobi"]["corpus_hint"] == "fiction"


def test_new_file(scan, library):
    first = scan()
    (library / "Nonfiction/lakes.epub").write_bytes(b"a book on lakes")
    second = scan()
    assert second["total_files"] == first["total_files"] + 1
    assert second["files_hashed_this_run"] == 1
    assert second["missing"] == 0
    assert by_name(scan)["lakes.epub"]["id"] == 7


def test_missing_then_pruned(scan, library):
    first = scan()
    (library / "Nonfiction/rivers.epub").unlink()
    flagged = scan()
    assert (flagged["missing"], flagged["newly_missing"]) == (1, 1)
    assert flagged["total_files"] == first["total_files"]
    since = by_name(scan)["rivers.epub"]["missing_since"]
    assert since is not None
    again = scan()
    assert (again["missing"], again["newly_missing"]) == (1, 0)
    assert by_name(scan)["rivers.epub"]["missing_since"] == since
    pruned = scan(prune=True)
    assert pruned["pruned"] == 1
    assert pruned["total_files"] == first["total_files"] - 1


def test_reappearing_file(scan, library):
    scan()
    before = by_name(scan)["rivers.epub"]
    place = library / "Nonfiction/rivers.epub"
    data = place.read_bytes()
    place.unlink()
    assert scan()["missing"] == 1
    place.write_bytes(data)
    assert scan()["missing"] == 0
    after = by_name(scan)["rivers.epub"]
    assert after["missing_since"] is None
    assert (after["id"], after["first_seen"]) == (before["id"], before["first_seen"])
    assert after["last_seen"] > before["last_seen"]


def test_runs_ledger(scan):
    first = scan()
    scan()
    runs = scan.catalog.runs().orderBy("started_at").collect()
    assert [r["run_id"] for r in runs][0] == first["run_id"]
    assert len(runs) == 2 and len({r["run_id"] for r in runs}) == 2
    assert (runs[0]["files_seen"], runs[0]["files_hashed"], runs[0]["errors"]) == (6, 5, 0)
    assert (runs[1]["files_seen"], runs[1]["files_hashed"]) == (6, 0)
    assert runs[0]["bytes_total"] == first["total_bytes"]
    assert runs[0]["started_at"] < runs[1]["started_at"] and runs[0]["note"] is None


def test_limit_flags_and_prunes_nothing(scan, library):
    scan()
    (library / "Nonfiction/rivers.epub").unlink()
    said = []
    part = scan(limit=2, prune=True, log=said.append)
    assert (part["files_seen"], part["missing"], part["pruned"]) == (2, 0, 0)
    assert part["total_files"] == 6
    assert any("prune is ignored" in s for s in said)
    # The walk starts with AudioBooks and ComicBookPDFs.
    touched = {n for n, r in by_name(scan).items() if r["run_id"] == part["run_id"]}
    assert touched == {"talk.mp3", "strip.cbz"}


def test_no_hash_then_hash(scan):
    bare = scan(hashing=False)
    assert bare["files_hashed_this_run"] == 0 and bare["duplicate_groups"] == 0
    assert scan()["files_hashed_this_run"] == 5
    kept = scan(hashing=False)
    assert kept["duplicate_groups"] == 1
    erased = scan(hashing=False, no_hash_policy="erase")
    assert erased["duplicate_groups"] == 0


def test_rehash_and_changed_content(scan, library):
    first = scan()
    assert scan(rehash=True)["files_hashed_this_run"] == 5
    before = by_name(scan)["talk.mp3"]["sha256"]
    (library / "AudioBooks/talk.mp3").write_bytes(b"another recording")
    changed = scan()
    assert changed["files_hashed_this_run"] == 1
    assert by_name(scan)["talk.mp3"]["sha256"] != before
    assert changed["total_bytes"] != first["total_bytes"]


def test_size_cap(scan):
    assert scan(max_hash_bytes=len(TWIN))["files_hashed_this_run"] == 5
    assert scan(max_hash_bytes=1, rehash=True)["files_hashed_this_run"] == 0
    rows = by_name(scan)
    assert all(r["sha256"] is None and r["error"] is None for r in rows.values())


def test_moved_file(scan, library):
    from shelfmark.operators import duplicates

    scan()
    (library / "Nonfiction/rivers.epub").rename(library / "Fiction/rivers.epub")
    result = scan()
    assert result["missing"] == 1 and result["duplicate_groups"] == 2
    moved = duplicates.moved(scan.catalog.files(), result["run_id"]).collect()
    assert [(r["old_path"], r["new_path"]) for r in moved] == [
        (f"{library}/Nonfiction/rivers.epub", f"{library}/Fiction/rivers.epub")
    ]


def test_roots(scan, library, tmp_path):
    first = scan()
    # An absent root is skipped, so its rows are not flagged; an empty one flags all its rows.
    other = tmp_path / "other"
    other.mkdir()
    (other / "x.txt").write_bytes(b"x")
    both = scan(roots=[str(library), str(other), str(tmp_path / "absent")])
    assert both["total_files"] == first["total_files"] + 1
    assert scan()["missing"] == 0
    (other / "x.txt").unlink()
    assert scan(roots=[str(other)])["missing"] == 1
    with pytest.raises(ValueError):
        scan(roots=[str(tmp_path / "absent")])


def test_overlapping_roots(scan, library):
    result = scan(roots=[str(library), str(library / "Fiction")])
    assert (result["files_seen"], result["total_files"]) == (7, 6)
    assert result["files_hashed_this_run"] == 5
    assert by_name(scan)["otters (copy).mobi"]["root"] == str(library / "Fiction")
    # The outer root alone takes the row back.
    assert scan()["missing"] == 0
    assert by_name(scan)["otters (copy).mobi"]["root"] == str(library)


def test_prune_is_refused_when_a_folder_cannot_be_listed(scan, library, monkeypatch):
    from shelfmark.sources import tree

    scan()
    (library / "Nonfiction/rivers.epub").unlink()
    real = tree.resolve_roots
    monkeypatch.setattr(
        tree, "resolve_roots", lambda roots, warn: real(roots, warn) + [str(library / "absent")]
    )
    said = []
    result = scan(prune=True, log=said.append)
    assert (result["unlisted_folders"], result["pruned"], result["missing"]) == (1, 0, 1)
    assert any("refused" in s for s in said)


def test_a_link_that_leads_nowhere_is_an_error_row(scan, library):
    (library / "Fiction/lost.epub").symlink_to(library / "nowhere")
    result = scan()
    assert result["errors"] == 1 and result["total_files"] == 7
    row = by_name(scan)["lost.epub"]
    assert row["error"].startswith("stat: ") and row["size_bytes"] is None
    assert row["category"] == "ebook_text"


def test_ids_are_never_reused(scan, library):
    scan()
    last = max(r["id"] for r in by_name(scan).values())
    gone = next(n for n, r in by_name(scan).items() if r["id"] == last)
    next(library.rglob(gone)).unlink()
    scan(prune=True)
    (library / "new.epub").write_bytes(b"new")
    scan()
    assert by_name(scan)["new.epub"]["id"] == last + 1
