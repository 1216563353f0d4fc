import fnmatch
import os
import re
from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark import schema as S
from shelfmark.functions import names
from shelfmark.functions.globs import any_component_regex
from shelfmark.operators import visits
from shelfmark.sources.store import decimal_text, iso_utc


def described(spark, paths, root="/r", **kw):
    df = spark.createDataFrame([(p, root) for p in paths], "path string, root string")
    return {r["path"]: r for r in names.described(df, **kw).collect()}


def test_vocabulary_sizes():
    exts = [e for group in S.EXTENSIONS.values() for e in group]
    assert len(exts) == len(set(exts)) == 74
    assert {k: len(v) for k, v in S.EXTENSIONS.items()} == {
        "ebook_text": 28, "pdf": 1, "ebook_image": 7, "audio": 12, "archive": 8, "metadata": 18,
    }
    assert set(S.SAME_FORMAT) <= set(exts)
    assert len(S.FILE_COLUMNS) == 20 and len(S.RUN_COLUMNS) == 9


@pytest.mark.parametrize("name,ext,fmt,category,eligible", [
    ("a.mobi", "mobi", "mobi", "ebook_text", 1),
    ("A.MOBI", "mobi", "mobi", "ebook_text", 1),
    ("a.mp3", "mp3", "mp3", "audio", 0),
    ("a.cbz", "cbz", "cbz", "ebook_image", 0),
    ("a.pdf", "pdf", "pdf", "pdf", 1),
    ("a.htm", "htm", "html", "ebook_text", 1),
    ("a.jpeg", "jpeg", "jpg", "metadata", 0),
    ("books.zip", "zip", "zip", "archive", 0),
    ("b.tgz", "tgz", "gz", "archive", 0),
    ("book.azw.res", "res", "res", "metadata", 0),
    ("x.mbpv2", "mbpv2", "mbpv2", "metadata", 0),
    ("x.voucher", "voucher", "voucher", "metadata", 0),
    ("x.phl", "phl", "phl", "metadata", 0),
    ("x.apnx", "apnx", "apnx", "metadata", 0),
    ("noext", "", "unknown", "other", 0),
    (".bashrc", "", "unknown", "other", 0),
    ("x.", "", "unknown", "other", 0),
    ("..epub", "epub", "epub", "ebook_text", 1),
    ("a.xyz", "xyz", "unknown", "other", 0),
    ("a.e pub", "e pub", "unknown", "other", 0),
    ("a.epub\n", "epub\n", "unknown", "other", 0),
])
def test_formats(spark, name, ext, fmt, category, eligible):
    row = described(spark, [f"/r/{name}"])[f"/r/{name}"]
    assert (row["ext"], row["fmt"], row["category"], row["rag_eligible"]) == (
        ext, fmt, category, eligible
    )


def test_path_parts(spark):
    rows = described(spark, ["/r/a.txt", "/r/x/b.txt", "/r/x/y/c d#é\".txt"])
    assert [(r["rel_path"], r["top_folder"], r["filename"]) for r in rows.values()] == [
        ("a.txt", "", "a.txt"), ("x/b.txt", "x", "b.txt"),
        ("x/y/c d#é\".txt", "x", "c d#é\".txt"),
    ]
    row = described(spark, ["/a/b"], root="/")["/a/b"]
    assert (row["rel_path"], row["top_folder"]) == ("a/b", "a")


def test_corpus_hint(spark):
    hints = {p: r["corpus_hint"] for p, r in described(spark, [
        "/x/NonFiction/b", "/x/fiction/b", "/x/GhostWriting/c", "/x/random/b", "/x/non fiction/n",
        "/x/pseudo-nonfiction/b", "/x/clients/untrusted", "/x/SciFi/b",
    ], root="/x").items()}
    assert list(hints.values()) == [
        "trusted-nonfiction", "fiction", "ghostwriting", "unassigned", "trusted-nonfiction",
        "untrusted-nonfiction", "ghostwriting", "fiction",
    ]
    # The whole path counts, the root included, unless only the top folder is asked for.
    path = "/srv/client/lib/History/romance.txt"
    root = "/srv/client/lib"
    assert described(spark, [path], root)[path]["corpus_hint"] == "ghostwriting"
    narrow = described(spark, [path], root, hint_scope="top_folder")
    assert narrow[path]["corpus_hint"] == "unassigned"
    with pytest.raises(ValueError):
        described(spark, [path], root, hint_scope="folder")


def component_excluded(name, globs):
    return any(fnmatch.fnmatchcase(name, g) for g in globs)


glob_text = st.text(alphabet="ab.*?[]!-x^\\", min_size=1, max_size=7)
name_text = st.text(alphabet="ab.[]!-x^\\*", min_size=1, max_size=6)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(glob_text, name_text), min_size=60, max_size=60))
def test_globs_match_like_fnmatch(spark, pairs):
    rows = [(n, any_component_regex([g]), component_excluded(n, [g])) for g, n in pairs]
    df = spark.createDataFrame(rows, "name string, regex string, expected boolean")
    wrong = df.where("(name rlike regex) <> expected").collect()
    assert not wrong


def test_exclusion_covers_folders_and_whole_names(spark):
    rel = ["a/.git/config", "x.tmp", "x.tmp.bak", "x.tmp\n", "d/y.part", "Lost+found/a",
           "lost+found/a", "@eaDir/q", "ok/.gitignore", ".DS_Store", "deep/.Trash-1000/f"]
    df = spark.createDataFrame([(r,) for r in rel], "rel string")
    kept = df.where(~names.excluded(F.col("rel"), S.DEFAULT_EXCLUDES)).collect()
    assert [r["rel"] for r in kept] == ["x.tmp.bak", "x.tmp\n", "Lost+found/a", "ok/.gitignore"]
    assert df.where(~names.excluded(F.col("rel"), [])).count() == len(rel)
    assert re.compile(any_component_regex(["a"]).replace(r"\z", r"\Z"))


part = st.text(alphabet="ab-. A", min_size=1, max_size=3).filter(lambda t: t not in (".", ".."))


@settings(max_examples=15, deadline=None)
@given(st.sets(st.lists(part, min_size=1, max_size=4).map(tuple), min_size=5, max_size=40))
def test_walk_order_is_that_of_a_walk(spark, tmp_path_factory, paths):
    base = tmp_path_factory.mktemp("walk")
    for parts in paths:
        place = base.joinpath(*parts)
        try:
            place.parent.mkdir(parents=True, exist_ok=True)
            place.touch()
        except OSError:
            pass  # a file is in the way of a folder
    walked = []
    for folder, subfolders, files in os.walk(base):
        subfolders.sort()
        walked += [os.path.join(folder, f) for f in sorted(files)]
    df = spark.createDataFrame(
        [(0, str(base), p) for p in sorted(walked)], "root_ordinal int, root string, path string"
    )
    for limit in (len(walked), len(walked) // 2):
        assert [r["path"] for r in visits.first_visits(df, limit).collect()] == walked[:limit]


def test_roots_overlap():
    assert visits.roots_overlap(["/a", "/a/b"])
    assert visits.roots_overlap(["/a", "/a"])
    assert visits.roots_overlap(["/a/c", "/b", "/"])
    assert visits.roots_overlap(["/a", "/a-b", "/a/b"])
    assert not visits.roots_overlap(["/a", "/ab", "/b"])


def test_decimal_text(spark):
    values = [1733000000.0, 1733000000.125, 1700000000.123456, 0.0, 1e-3, 1709251200.9999998]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shown = [r[0] for r in df.selectExpr(decimal_text("v")).collect()]
    assert shown == [repr(v) for v in values]
    assert spark.sql(f"SELECT {decimal_text('double(NULL)')}").first()[0] is None


def test_iso_text_ignores_the_session_zone(spark):
    at = datetime(2024, 7, 1, 3, 4, 5, tzinfo=timezone.utc)
    text = iso_utc(f"timestamp_seconds({int(at.timestamp())})")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert spark.sql(f"SELECT {text}").first()[0] == "2024-07-01T03:04:05+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
