"""Decisions after a scan on a small catalog: nulls, ties, hot groups, and moves taken back."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import curation

SCHEMA = (
    "path string, root string, rel_path string, top_folder string, filename string, ext string,"
    " fmt string, rag_eligible int, sha256 string, corpus string, corpus_hint string,"
    " first_seen timestamp, missing_since timestamp"
)


def catalog(spark, rows):
    """Rows of (path below /r, sha256, corpus, gone)."""
    found = spark.createDataFrame(rows, "p string, sha256 string, corpus string, gone boolean")
    return found.selectExpr(
        "concat('/r/', p) AS path", "'/r' AS root", "p AS rel_path", "'' AS top_folder",
        "substring_index(p, '/', -1) AS filename", "lower(substring_index(p, '.', -1)) AS ext",
        "lower(substring_index(p, '.', -1)) AS fmt",
        "int(substring_index(p, '.', -1) IN ('epub', 'mobi', 'pdf', 'txt')) AS rag_eligible",
        "sha256", "corpus", "'unassigned' AS corpus_hint", "timestamp_seconds(0) AS first_seen",
        "if(gone, timestamp_seconds(9), NULL) AS missing_since",
    )


@pytest.fixture(scope="module")
def files(spark):
    return catalog(spark, [
        ("b/Ann Émile - A Tale.epub", "1", "fiction", False),
        ("a/ann emile - a  tale!.epub", "1", "fiction", True),
        ("c/x.epub", "1", "trusted-nonfiction", False),
        ("d/Ann Emile - A Tale.pdf", "2", "fiction", False),
        ("e/ANN EMILE - A TALE.mobi", None, "fiction", False),
        ("f/none.txt", None, None, False),
        ("g/!!.txt", "5", "fiction", False),
        ("h/cover.jpg", "6", "fiction", False),
        ("i/same.txt", "7", "fiction", False),
        ("j/same.txt", "8", "fiction", False),
    ])


@pytest.fixture(scope="module")
def decided(spark, files):
    named = spark.createDataFrame([], "path string, name string")
    return curation.decided(curation.with_keeper(curation.titled(files, named)))


def by_path(df, column):
    return {r["path"].removeprefix("/r/"): r[column] for r in df.collect()}


def test_decisions(decided):
    found = by_path(decided, "decision")
    assert found == {
        "b/Ann Émile - A Tale.epub": "keep", "a/ann emile - a  tale!.epub": "drop",
        "c/x.epub": "keep", "d/Ann Emile - A Tale.pdf": "review",
        "e/ANN EMILE - A TALE.mobi": "review", "f/none.txt": "keep", "g/!!.txt": "keep",
        "h/cover.jpg": "keep", "i/same.txt": "keep", "j/same.txt": "keep",
    }
    assert set(by_path(decided.where("author <> ''"), "title_key").values()) == {"a tale"}


def test_moves_and_their_inverse(decided, files):
    moves = curation.manifest(curation.layout(decided, "/lib"), "/lib")
    found = {r["src"].removeprefix("/r/"): (r["action"], r["dst"]) for r in moves.collect()}
    assert found == {
        "b/Ann Émile - A Tale.epub": ("move", "/lib/fiction/ann emile/a tale/a tale.epub"),
        "c/x.epub": ("move", "/lib/trusted-nonfiction/unknown/x/x.epub"),
        "d/Ann Emile - A Tale.pdf": ("review", None), "e/ANN EMILE - A TALE.mobi": ("review", None),
        "f/none.txt": ("review", None),
        "g/!!.txt": ("move", "/lib/fiction/unknown/untitled/untitled.txt"),
        "h/cover.jpg": ("move", "/lib/_non_rag/r/h/cover.jpg"),
        "i/same.txt": ("conflict", None), "j/same.txt": ("conflict", None),
    }
    moved = curation.applied(files, moves)
    assert moved.where("startswith(path, '/lib/')").count() == 4
    assert moved.where("rel_path = '_non_rag/r/h/cover.jpg' AND top_folder = '_non_rag'").count() == 1
    back = curation.applied(moved, curation.inverse(moves))
    columns = ["path", "root", "rel_path", "filename", "sha256"]
    assert sorted(map(str, back.select(columns).collect())) == sorted(
        map(str, files.select(columns).collect())
    )


def test_assignments(spark, files):
    given = spark.createDataFrame(
        [("1", "fiction"), ("1", "fiction"), ("2", "fiction"), ("2", "ghostwriting"), ("5", "ghostwriting"),
         (None, "fiction"), ("6", None)], "sha256 string, corpus string",
    )
    found = curation.assigned(files, given)
    assert by_path(found, "corpus")["c/x.epub"] == "fiction"
    assert by_path(found, "corpus")["g/!!.txt"] == "ghostwriting"
    assert by_path(curation.for_review(found), "reason") == {
        "d/Ann Emile - A Tale.pdf": "ambiguous", "f/none.txt": "unassigned",
    }


def test_chunks_give_whole_texts_back(spark, decided):
    texts = [("/r/c/x.epub", "é\n\U0001f600" * 1000), ("/r/i/same.txt", ""), ("/r/j/same.txt", None),
             ("/r/b/Ann Émile - A Tale.epub", "x" * 1000), ("/r/nowhere", "lost")]
    found = curation.chunks(decided, spark.createDataFrame(texts, "path string, text string"))
    rows = sorted(found.collect(), key=lambda r: (r["path"], r["chunk_no"]))
    whole = {}
    for r in rows:
        assert r["location"] == len(whole.get(r["path"], ""))
        whole[r["path"]] = whole.get(r["path"], "") + r["chunk"]
    assert whole == dict(t for t in texts if t[1] and t[0] != "/r/nowhere")
    sizes = {tuple(r) for r in curation.collection_sizes(found).collect()}
    assert sizes == {("fiction", 1, 1, 1000), ("trusted-nonfiction", 1, 3, 3000)}


def test_conversion(spark, decided):
    done = spark.createDataFrame([("5",), (None,)], "sha256 string")
    held = spark.createDataFrame([("7", 3), ("7", None)], "sha256 string, n_chars long")
    found = curation.to_convert(decided, done, held)
    assert by_path(found, "ocr") == {"f/none.txt": False, "i/same.txt": False, "j/same.txt": False}


def test_empty_catalog(spark, files):
    named = spark.createDataFrame([], "path string, name string")
    none = curation.decided(curation.with_keeper(curation.titled(files.where("false"), named)))
    assert none.count() == 0
    assert curation.manifest(curation.layout(none, "/lib"), "/lib").count() == 0


def test_hot_hash_and_title(spark):
    """A content and a title that hold most of the catalog: one keeper, no group gathered."""
    many = spark.range(60_000).select(
        F.format_string("n%06d/t.txt", "id").alias("p"),
        F.when(F.col("id") < 50_000, F.lit("hot")).alias("sha256"),
        F.lit("fiction").alias("corpus"), F.lit(False).alias("gone"),
    )
    files = catalog(spark, many.collect())
    named = spark.createDataFrame([], "path string, name string")
    decided = curation.decided(curation.with_keeper(curation.titled(files, named)))
    found = {r["decision"]: r["count"] for r in decided.groupBy("decision").count().collect()}
    assert found == {"drop": 49_999, "keep": 10_001}
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_" not in plan


def test_copies_of_different_hints_are_not_compared(spark):
    """A file without a corpus belongs where its hint says; copies elsewhere are none."""
    files = catalog(spark, [("a/x.txt", "1", None, False), ("b/x.txt", "1", None, False),
                            ("c/x.txt", "1", "fiction", False), ("d/x.txt", "1", None, False)])
    hints = F.when(F.col("path").contains("/a/"), "fiction").when(F.col("path").contains("/b/"), "ghostwriting")
    files = files.withColumn("corpus_hint", F.coalesce(hints, F.lit("unassigned")))
    named = spark.createDataFrame([], "path string, name string")
    found = curation.decided(curation.with_keeper(curation.titled(files, named)))
    assert by_path(found, "keeper") == {
        "a/x.txt": "/r/a/x.txt", "b/x.txt": None, "c/x.txt": "/r/a/x.txt", "d/x.txt": None,
    }
    assert by_path(found, "decision") == {"a/x.txt": "keep", "b/x.txt": "keep", "c/x.txt": "drop", "d/x.txt": "keep"}
