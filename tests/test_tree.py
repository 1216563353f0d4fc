"""The census source on trees with every kind of entry."""

import os

import pytest

from shelfmark import schema as S
from shelfmark.sources import tree


def scan(spark, tmp_path_factory, roots, **kw):
    staging = str(tmp_path_factory.mktemp("stage"))
    kw.setdefault("exclude", [])
    return tree.census(spark, [str(r) for r in roots], staging, **kw)


def rels(found, base):
    return sorted(os.path.relpath(r["path"], base) for r in found.entries.collect())


@pytest.fixture
def odd(tmp_path):
    base = tmp_path / "odd"
    for rel in (
        "plain.txt", ".hidden.txt", "_under/x.mobi", "zero.epub", "dot.", "noext",
        "book.azw.res", 'sp ace #é".txt', "x._COPYING_", "junk/@eaDir/thumb.jpg", "junk/x.tmp",
        "deep/a/b/c/d.txt",
    ):
        place = base / rel
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes(b"" if rel == "zero.epub" else b"bytes")
    (tmp_path / "outside").mkdir()
    (tmp_path / "outside/elsewhere.txt").write_bytes(b"far away")
    (base / "dangling").symlink_to(tmp_path / "nowhere")
    (base / "link.txt").symlink_to(tmp_path / "outside/elsewhere.txt")
    (base / "folder-link").symlink_to(tmp_path / "outside")
    os.mkfifo(base / "pipe")
    return base


ALWAYS = [
    "plain.txt", ".hidden.txt", "_under/x.mobi", "zero.epub", "dot.", "noext", "book.azw.res",
    'sp ace #é".txt', "x._COPYING_", "deep/a/b/c/d.txt", "dangling", "link.txt", "pipe",
]
JUNK = ["junk/@eaDir/thumb.jpg", "junk/x.tmp"]


def test_every_kind_of_entry(spark, tmp_path_factory, odd):
    found = scan(spark, tmp_path_factory, [odd])
    assert rels(found, odd) == sorted(ALWAYS + JUNK)
    rows = {os.path.relpath(r["path"], odd): r for r in found.entries.collect()}
    assert rows["zero.epub"]["size_bytes"] == 0
    assert rows["link.txt"]["size_bytes"] == len(b"far away")
    assert rows["dangling"]["error"].startswith("stat: ")
    assert rows["dangling"]["size_bytes"] is None and rows["dangling"]["mtime"] is None
    assert rows["plain.txt"]["mtime"] == os.stat(odd / "plain.txt").st_mtime
    assert {r["root"] for r in rows.values()} == {str(odd)}
    assert found.rounds == 1


def test_exclusion_prunes_folders(spark, tmp_path_factory, odd):
    found = scan(spark, tmp_path_factory, [odd], exclude=S.DEFAULT_EXCLUDES)
    assert rels(found, odd) == sorted(ALWAYS)


def test_root_name_is_not_tested(spark, tmp_path_factory, tmp_path):
    (tmp_path / "lib.tmp").mkdir()
    (tmp_path / "lib.tmp/a.txt").touch()
    found = scan(spark, tmp_path_factory, [tmp_path / "lib.tmp"], exclude=["*.tmp"])
    assert found.entries.count() == 1


def test_following_links(spark, tmp_path_factory, odd):
    found = scan(spark, tmp_path_factory, [odd], follow_links=True)
    assert rels(found, odd) == sorted(ALWAYS + JUNK + ["folder-link/elsewhere.txt"])


def test_link_cycles_end_where_a_walk_ends(spark, tmp_path_factory, tmp_path):
    base = tmp_path / "cycle"
    (base / "a").mkdir(parents=True)
    (base / "a/x.txt").touch()
    (base / "a/again").symlink_to(base / "a")
    walked = sorted(
        os.path.relpath(os.path.join(folder, f), base)
        for folder, _, files in os.walk(base, followlinks=True) for f in files
    )
    assert len(walked) > 30
    found = scan(spark, tmp_path_factory, [base], follow_links=True, budget=10)
    assert rels(found, base) == walked


@pytest.mark.parametrize("budget", [1, 3, 7])
def test_small_budgets_take_rounds_but_lose_nothing(spark, tmp_path_factory, odd, budget):
    found = scan(spark, tmp_path_factory, [odd], budget=budget)
    assert found.rounds > 1
    assert rels(found, odd) == sorted(ALWAYS + JUNK)


def test_hot_folder_is_looked_up_by_many_tasks(spark, tmp_path_factory, tmp_path):
    base = tmp_path / "hot"
    base.mkdir()
    for i in range(600):
        (base / f"{i:04}.txt").write_bytes(b"x" * i)
    found = scan(spark, tmp_path_factory, [base], budget=50)
    rows = found.entries.collect()
    assert len(rows) == len({r["path"] for r in rows}) == 600
    assert sum(r["size_bytes"] for r in rows) == sum(range(600))
    assert found.rounds == 2


def test_overlapping_roots_are_both_visited(spark, tmp_path_factory, odd):
    found = scan(spark, tmp_path_factory, [odd, odd / "deep"])
    deep = [r for r in found.entries.collect() if r["path"].endswith("d.txt")]
    assert sorted((r["root_ordinal"], r["root"]) for r in deep) == [
        (0, str(odd)), (1, str(odd / "deep")),
    ]


def test_unlisted_folder_is_reported(spark, tmp_path_factory, tmp_path):
    (tmp_path / "real").mkdir()
    (tmp_path / "real/a.txt").touch()
    found = scan(spark, tmp_path_factory, [tmp_path / "real", tmp_path / "gone"])
    assert found.entries.count() == 1
    assert found.unlisted_count == 1
    row = found.unlisted.first()
    assert row["path"] == str(tmp_path / "gone") and row["error"].startswith("list: ")


def test_names_that_are_not_utf8(spark, tmp_path_factory, tmp_path):
    base = os.fsencode(tmp_path / "raw")
    os.makedirs(base + b"/fo\xff")
    for name in (b"/a\xff.txt", b"/fo\xff/b.txt"):
        with open(base + name, "wb") as f:
            f.write(b"abc")
    found = scan(spark, tmp_path_factory, [tmp_path / "raw"], budget=1)
    rows = sorted((r["path"], r["size_bytes"], r["error"]) for r in found.entries.collect())
    assert [p for p, _, _ in rows] == [
        f"{tmp_path}/raw/a\\xff.txt\0", f"{tmp_path}/raw/fo\\xff/b.txt\0"
    ]
    assert all(size == 3 and "UTF-8" in error for _, size, error in rows)


def test_resolve_roots(tmp_path, monkeypatch):
    (tmp_path / "lib").mkdir()
    (tmp_path / "alias").symlink_to(tmp_path / "lib")
    monkeypatch.setenv("HOME", str(tmp_path))
    said = []
    roots = tree.resolve_roots(["~/alias", str(tmp_path / "gone")], warn=said.append)
    assert roots == [str(tmp_path / "lib")]
    assert len(said) == 1 and "gone" in said[0]
    with pytest.raises(ValueError):
        tree.resolve_roots([str(tmp_path / "gone")], warn=said.append)


def test_names_that_escape_alike_stay_apart(spark, tmp_path_factory, tmp_path):
    root = os.fsencode(str(tmp_path_factory.mktemp("alike")))
    for name in (b"a\xff.txt", b"a\\xff.txt", b"a\\\\xff.txt"):
        with open(os.path.join(root, name), "wb") as f:
            f.write(name)
    found = tree.census(spark, [os.fsdecode(root)], str(tmp_path / "work")).entries.collect()
    assert len(found) == len({r["path"] for r in found}) == 3
