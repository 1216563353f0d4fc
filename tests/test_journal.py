"""A scan that dies while hashing leaves its finished waves to the next one."""

import os

import pytest

from shelfmark.plans.rescan import rescan
from shelfmark.sources import content, journal
from shelfmark.sources.store import Catalog


@pytest.fixture
def library(tmp_path):
    base = tmp_path / "library"
    base.mkdir()
    for i in range(40):
        (base / f"book{i}.epub").write_bytes(b"words %d " % i * (i + 1))
    return base


def scan(spark, tmp_path, library, **settings):
    # about ten files a wave
    settings = {"wave_bytes": 10 * content.OPEN_COST, "log": lambda *_: None} | settings
    return rescan(spark, str(tmp_path / "catalog"), [str(library)], **settings)


def die_after(monkeypatch, waves):
    append = journal.Journal.append

    def dying(self, hashed, scan, wave):
        if wave >= waves:
            raise RuntimeError("lost")
        return append(self, hashed, scan, wave)

    monkeypatch.setattr(journal.Journal, "append", dying)


def killed(spark, tmp_path, library, waves=1, **settings):
    with pytest.MonkeyPatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        die_after(patch, waves)
        scan(spark, tmp_path, library, **settings)


def stored(spark, tmp_path):
    rows = Catalog(spark, str(tmp_path / "catalog")).files().collect()
    return {r["filename"]: r["sha256"] for r in rows}


def test_only_the_rest_is_hashed(spark, tmp_path, library):
    whole = scan(spark, tmp_path / "other", library)
    assert whole["files_hashed_this_run"] == 40 and whole["hashes_resumed"] == 0
    killed(spark, tmp_path, library)
    assert Catalog(spark, str(tmp_path / "catalog")).latest() is None
    first = journal.Journal(spark, str(tmp_path / "catalog"), 1).known().count()
    assert 0 < first < 40
    result = scan(spark, tmp_path, library)
    assert (result["hashes_resumed"], result["files_hashed_this_run"]) == (first, 40 - first)
    assert stored(spark, tmp_path) == stored(spark, tmp_path / "other")
    again = scan(spark, tmp_path, library)
    assert again["hashes_resumed"] == again["files_hashed_this_run"] == 0


def test_several_deaths_add_up(spark, tmp_path, library):
    killed(spark, tmp_path, library, waves=1)
    killed(spark, tmp_path, library, waves=1)
    known = journal.Journal(spark, str(tmp_path / "catalog"), 1).known().count()
    result = scan(spark, tmp_path, library)
    assert result["hashes_resumed"] == known and result["files_hashed_this_run"] == 40 - known
    assert None not in stored(spark, tmp_path).values()


def test_changed_files_and_errors_are_read_again(spark, tmp_path, library):
    (library / "pipe.epub").symlink_to("/dev/null")  # hashing it is an error
    killed(spark, tmp_path, library, waves=3)
    names = {
        os.path.basename(r.path)
        for r in journal.Journal(spark, str(tmp_path / "catalog"), 1).known().collect()
    }
    assert "pipe.epub" not in names and len(names) >= 2
    changed, touched = sorted(names)[:2]
    (library / changed).write_bytes(b"something else")
    os.utime(library / touched, (1, 1))
    result = scan(spark, tmp_path, library)
    assert result["hashes_resumed"] == len(names) - 2
    assert result["files_hashed_this_run"] == 40 - len(names) + 2
    scan(spark, tmp_path / "other", library)
    assert stored(spark, tmp_path) == stored(spark, tmp_path / "other")


def test_rehash_takes_nothing_over(spark, tmp_path, library):
    killed(spark, tmp_path, library)
    result = scan(spark, tmp_path, library, rehash=True)
    assert (result["hashes_resumed"], result["files_hashed_this_run"]) == (0, 40)


def test_journal_of_a_commit_is_not_read_again(spark, tmp_path, library):
    """What a committed scan journaled serves no later scan: a hash dropped on purpose stays so."""
    scan(spark, tmp_path, library)
    scan(spark, tmp_path, library, hashing=False, no_hash_policy="erase")
    result = scan(spark, tmp_path, library)
    assert (result["hashes_resumed"], result["files_hashed_this_run"]) == (0, 40)
