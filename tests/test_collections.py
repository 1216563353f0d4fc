"""Collections follow the catalog: what is rewritten, what a dead run leaves, odd rows."""

import shutil
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import collections

BOOK = "path string, sha256 string, corpus string, author string, book string"


@pytest.fixture
def shelf(spark, tmp_path):
    return Shelf(spark, tmp_path)


class Shelf:
    def __init__(self, spark, tmp_path):
        self.spark, self.folder = spark, str(tmp_path / "collections")

    def sync(self, books, texts):
        wanted = self.spark.createDataFrame(books, BOOK)
        held = self.spark.createDataFrame([*texts.items()], "path string, text string")
        # heading: a line of capitals
        found = collections.sync(self.folder, wanted, held, f"c/{uuid.uuid4().hex}", "[A-Z]+", slots=8)
        return {r.path: r.op for r in found.collect()}

    def held(self):
        rows = collections.stored(self.spark, self.folder).orderBy("chapter_no", "chunk_no").collect()
        out = {}
        for r in rows:
            key = r.path, r.sha256, r.corpus, r.author, r.book
            out[key] = out.get(key, "") + r.chunk
        return out

    def files(self):
        return {str(p) for p in Path(self.folder).rglob("*.parquet")}


BOOKS = [(f"/b{i}", f"h{i}", ("fiction", "trusted-nonfiction")[i % 2], "Ann", f"T{i}") for i in range(40)]
TEXTS = {f"/b{i}": f"ONE\nwords {i}\nTWO\n" + "é" * 1500 for i in range(40)}


def whole(books):
    return {b: TEXTS[b[0]] for b in books}


def test_a_reassigned_book_takes_its_passages_along(shelf):
    assert shelf.sync(BOOKS, TEXTS) == {b[0]: "insert" for b in BOOKS}
    assert shelf.held() == whole(BOOKS)
    before = shelf.files()
    assert len(before) == len(list(Path(shelf.folder).glob('*/slot=*'))) > 10
    assert shelf.sync(BOOKS, {}) == {} and shelf.files() == before
    moved = [("/b0", "h0", "ghostwriting", "Ann", "T0"), *BOOKS[1:]]
    assert shelf.sync(moved, {}) == {"/b0": "move"}  # no text is read
    assert shelf.held() == whole(moved)
    assert len(before - shelf.files()) == 1 and len(shelf.files() - before) == 2


def test_all_changes(shelf):
    shelf.sync(BOOKS, TEXTS)
    now = [("/b1", "h1", "trusted-nonfiction", "Ben", "T1"), ("/b2", "new", "fiction", "Ann", "T2"),
           ("/b3", "h3", "trusted-nonfiction", None, "T3"), ("/new", None, "fiction", "Cy", "N"),
           (None, "x", "fiction", "", ""), ("/lost", "x", None, "", ""), ("/void", "v", "fiction", "", ""),
           ("/none", "v", "fiction", "", ""), *BOOKS[5:]]
    texts = {"/b2": "other", "/new": "fresh", "/void": "", "/none": None}
    found = shelf.sync(now, texts)
    assert found == {"/b0": "delete", "/b1": "retitle", "/b2": "change", "/b3": "retitle", "/b4": "delete",
                     "/new": "insert", "/void": "insert", "/none": "insert"}
    assert shelf.held() == {now[0]: TEXTS["/b1"], now[1]: "other", now[2]: TEXTS["/b3"], now[3]: "fresh",
                            **whole(BOOKS[5:])}
    # a book without a hash may have changed each time; those without text rewrite nothing
    before = shelf.files()
    assert shelf.sync(now, texts) == {"/new": "change", "/void": "insert", "/none": "insert"}
    assert len(shelf.files() - before) == 1


def test_all_books_go(shelf):
    shelf.sync(BOOKS, TEXTS)
    assert set(shelf.sync([], {}).values()) == {"delete"}
    assert shelf.held() == {} and not shelf.files()
    assert shelf.sync([], {}) == {}
    assert set(shelf.sync(BOOKS, TEXTS).values()) == {"insert"} and shelf.held() == whole(BOOKS)


def test_what_a_dead_run_leaves_is_made_good(shelf, spark):
    shelf.sync(BOOKS, TEXTS)
    slots = sorted(Path(shelf.folder).glob("corpus=fiction/slot=*"))
    stays = Path(shelf.folder, "corpus=ghostwriting", slots[0].name)
    shutil.copytree(slots[0], stays)  # books moved here, and not yet gone from where they were
    twice = {p for p, c in spark.read.parquet(str(stays)).select("path", "chunk").collect()}
    shutil.rmtree(slots[1])  # and a slot gone before the new one came
    lost = {b[0] for b in BOOKS} - {key[0] for key in shelf.held()}
    assert twice and lost
    found = shelf.sync(BOOKS, TEXTS)
    assert found == {**{p: "repeated" for p in twice}, **{p: "insert" for p in lost}}
    assert shelf.held() == whole(BOOKS)
    shutil.copytree(slots[0], stays)
    elsewhere = [(p, h, "untrusted-nonfiction" if p in twice else c, a, t) for p, h, c, a, t in BOOKS]
    assert shelf.sync(elsewhere, {}) == {p: "move" for p in twice}
    assert shelf.held() == whole(elsewhere)


def test_other_number_of_slots(shelf, spark):
    shelf.sync(BOOKS, TEXTS)
    wanted = spark.createDataFrame([(*BOOKS[0][:2], "ghostwriting", "Ann", "T0"), *BOOKS[1:]], BOOK)
    texts = spark.createDataFrame([], "path string, text string")
    collections.sync(shelf.folder, wanted, texts, f"c/{uuid.uuid4().hex}", slots=100)
    assert shelf.held() == whole([("/b0", "h0", "ghostwriting", "Ann", "T0"), *BOOKS[1:]])


def test_reads_touched_slots_only(shelf, spark):
    shelf.sync(BOOKS, TEXTS)
    found = collections.stored(spark, shelf.folder).where(collections._in({("fiction", 1), ("fiction", 2)}))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert {tuple(r) for r in found.select("corpus", "slot").distinct().collect()} <= {("fiction", 1), ("fiction", 2)}
    assert found.withColumn("file", F.input_file_name()).select("file").distinct().count() <= 2
