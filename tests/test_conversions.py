"""The log of conversions against a replay in Python, its compaction, and what expires."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from shelfmark import schema as S
from shelfmark.sources import conversions, folders
from shelfmark.sources.conversions import ConversionLog
from shelfmark.sources.store import Catalog

OUTCOME = "path string, sha256 string, status string, error string, at timestamp, content string"
AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


def outcome(path, sha, status, error=None, hour=0):
    return path, sha, status, error, AT + timedelta(hours=hour), "clash"


def states(log):
    return {r["content"]: (r["attempts"], r["status"], r["error"], r["run_id"]) for r in log.states().collect()}


def test_states_against_a_replay(spark, tmp_path):
    rng = random.Random(4)
    log = ConversionLog(spark, str(tmp_path / "cat"))
    assert states(log) == {} and log.compact() == 0
    tries = defaultdict(list)
    for batch in range(4):
        rows = []
        for i in range(40):
            sha = rng.choice(["hot", None, "a", "b", "c", "d"])
            row = outcome(f"/f{rng.randrange(5)}", sha, rng.choice(["converted", "failed"]), f"e{i}", batch * 100 + i)
            rows.append(row)
            tries[sha or row[0]].append((row[4], row[2], row[3], f"run-{batch}"))
        log.append(spark.createDataFrame(rows, OUTCOME), f"run-{batch}")
        wanted = {}
        for content, seen in tries.items():
            _, status, error, run = max(seen)
            wanted[content] = (len(seen), status, error if status == "failed" else None, run)
        assert states(log) == wanted
        if batch == 2:
            assert log.compact() == 3
            assert len(folders.names_in(spark, log.place)) == 1 and states(log) == wanted
    assert log.compact() == 2 and log.compact() == 1 and states(log) == wanted
    good = {r["sha256"] for r in log.converted().collect()}
    assert good == {c for c, v in wanted.items() if v[1] == "converted"}


def test_ties_and_old_news(spark, tmp_path):
    """At one time a success counts; an outcome that comes in late does not replace a later one."""
    log = ConversionLog(spark, str(tmp_path))
    log.append(spark.createDataFrame([
        outcome("/a", "x", "failed", "zz", 5), outcome("/b", "x", "converted", None, 5)], OUTCOME), "one")
    log.append(spark.createDataFrame([outcome("/a", "x", "failed", "late", 1)], OUTCOME), "two")
    assert states(log) == {"x": (2, "converted", None, "one")}


def test_a_compaction_that_died_before_removing(spark, tmp_path, monkeypatch):
    log = ConversionLog(spark, str(tmp_path))
    for run in ("one", "two"):
        log.append(spark.createDataFrame([outcome("/a", "x", "failed", run, len(run))], OUTCOME), run)
    before = states(log)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(folders, "remove", die)
        with pytest.raises(RuntimeError):
            log.compact()
    assert states(log) == before and len(folders.names_in(spark, log.place)) == 3
    # a batch whose job died is no batch, and is left alone
    (Path(log.place) / "batch-dead" / "_temporary").mkdir(parents=True)
    assert log.compact() == 3 and states(log) == before
    assert "batch-dead" in folders.names_in(spark, log.place)


@pytest.mark.parametrize("row", [
    outcome("/a", "x", "done"), outcome("/a", "x", None), outcome(None, None, "failed"),
    ("/a", "x", "failed", None, None, "clash"),
])
def test_what_is_no_outcome(spark, tmp_path, row):
    log = ConversionLog(spark, str(tmp_path))
    with pytest.raises(Exception, match="not an outcome"):
        log.append(spark.createDataFrame([row], OUTCOME), "one")
    assert states(log) == {}


def test_status_of_files(spark, tmp_path):
    log = ConversionLog(spark, str(tmp_path))
    log.append(spark.createDataFrame([
        outcome("/old", "x", "converted"), outcome("/b", None, "failed", "exit 1"),
        outcome("/c", "y", "failed", "exit 2"), outcome("/c", "y", "failed", "exit 3", 1)], OUTCOME), "one")
    files = spark.createDataFrame(
        [("/moved", "x", "mobi"), ("/b", None, "pdf"), ("/c", "y", "pdf"), ("/d", "z", "mobi"), ("/e", "x", "epub")],
        "path string, sha256 string, fmt string",
    ).selectExpr("*", "timestamp(NULL) AS missing_since", "1 AS rag_eligible", "string(NULL) AS keeper",
                 "'keep' AS decision", "'clash' AS status", "'clash' AS attempts")
    rows = conversions.status(files, log.states(), "/library")
    assert {r["path"]: (r["status"], r["attempts"], r["error"], r["target"]) for r in rows.collect()} == {
        "/moved": ("converted", 1, None, "/library/_converted/x.epub"),
        "/b": ("failed", 1, "exit 1", None), "/c": ("failed", 2, "exit 3", None),
        "/d": ("pending", 0, None, None),
    }
    assert [r["path"] for r in conversions.to_retry(rows, 2).collect()] == ["/b"]


def test_the_last_runs_stay_readable(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "cat"))
    assert catalog.expire(1) == []
    for seq, run_id in enumerate(["one", "two", "three", "four"], 1):
        rows = spark.createDataFrame([(f"/{run_id}",)], "path string").selectExpr(
            *[f"CAST({'path' if f.name == 'path' else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
              for f in S.FILES])
        work = tmp_path / f"scan-{run_id}"
        work.mkdir()
        buckets = catalog.write_snapshot(rows, run_id)
        if run_id != "four":  # at work, and not committed yet
            catalog.commit({"run_id": run_id, "seq": seq, "last_id": 0, "buckets": buckets, "staging": str(work)})
        (tmp_path / "cat" / "hashes" / f"{seq:012d}").mkdir(parents=True)
    assert catalog.expire(2) == ["one"] and catalog.expire(2) == []
    assert not (tmp_path / "scan-one").exists() and (tmp_path / "scan-two").exists()
    assert folders.names_in(spark, f"{catalog.folder}/files") == ["four", "three", "two"]
    assert folders.names_in(spark, f"{catalog.folder}/hashes") == [f"{4:012d}"]
    for run_id in ("two", "three", "four"):
        assert [r["path"] for r in catalog.snapshot(run_id).collect()] == [f"/{run_id}"]
    assert catalog.runs().count() == 3 and [r["path"] for r in catalog.prior().collect()] == ["/three"]
    with pytest.raises(ValueError):
        catalog.expire(0)
