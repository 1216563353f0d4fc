"""Passages cut by content: a plain rolling rule, whole texts, and few new ones after a change."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import passages


def plain(text):
    """Character by character."""
    out, begin = [], 0
    for i in range(len(text)):
        window = text[max(0, i - passages.WINDOW + 1) : i + 1]
        total = sum(ord(c) * pow(257, j, 1_000_003) for j, c in enumerate(reversed(window)))
        size = i + 1 - begin
        if size >= 256 and total % 1_000_003 % 512 == 0 or size == 4096 or i + 1 == len(text):
            out.append(i + 1)
            begin = i + 1
    return out


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeéß漢", k=rng.randint(1, 9))) for _ in range(500)]
    return " ".join(rng.choices(words, k=6000))


def test_ends(prose, monkeypatch):
    for text in ["", "a", "x" * 9000, prose[:300], prose]:
        assert passages.ends(text) == plain(text)
    monkeypatch.setattr(passages, "BLOCK", 100)  # blocks meet within windows
    assert passages.ends(prose) == plain(prose)


def test_an_inserted_sentence(spark, prose):
    changed = prose[:15000] + "Here is a sentence that was not there before. " + prose[15000:]
    docs = spark.createDataFrame(
        [("a", "x", "c1", prose), ("b", "y", "c1", changed), ("c", None, "c1", None), ("d", None, "c1", "")],
        "path string, chunk_key_of string, corpus string, text string",
    )
    found = passages.content_chunks(docs)
    rows = found.orderBy("path", "chunk_no").collect()
    for path, text in (("a", prose), ("b", changed)):
        own = [r for r in rows if r.path == path]
        assert "".join(r.chunk for r in own) == text
        assert [r.location for r in own] == [0, *passages.ends(text)[:-1]]
        assert all(r.chunk_key == hashlib.sha256(r.chunk.encode()).hexdigest() for r in own)
    assert {r.path for r in rows} == {"a", "b"}
    fresh = passages.to_embed(found.where("path = 'b'"), found.where("path = 'a'")).collect()
    assert 1 <= len(fresh) <= 3 < sum(r.path == "b" for r in rows)
    none = passages.to_embed(found, found.withColumn("corpus", F.lit("other")))
    assert none.count() == len({r.chunk_key for r in rows})


def test_files_without_a_hash_stay_apart(spark, prose):
    docs = spark.createDataFrame(
        [("a", None, "c", prose[:2000]), ("b", None, "c", prose[3000:5000]), ("e", None, "c", prose[:2000])],
        "path string, sha256 string, corpus string, text string",
    )
    found = passages.content_chunks(docs)
    wanted = passages.to_embed(found, found.where("false"))
    held = {r.path for r in wanted.collect()}
    assert held == {"a", "b"}
