"""Chapters and passages against a walk over lines; whole texts; odd texts and columns."""

import random
import re

import pytest

from shelfmark.operators import chapters


def plain(text, heading):
    """(chapter_no, chapter, chunk_no, location, chunk) line by line."""
    sections = []
    for line in text.split("\n"):
        head = re.fullmatch(rf"(?:{heading})[ \t\r]*", line)
        if head or not sections:
            sections.append([line.strip("# \t\r") or None if head else None, []])
        sections[-1][1].append(line)
    bodies = ["\n".join(lines) for _, lines in sections]
    bodies = [b + "\n" for b in bodies[:-1]] + bodies[-1:]
    return [
        (no, title, at // 1000, at, body[at : at + 1000])
        for no, ((title, _), body) in enumerate(zip(sections, bodies))
        for at in range(0, len(body), 1000)
    ]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    lines = ["# One", "## Zwei  ", "####", "#", "Chapter 3", "CHAPITRE IV: l'été", "chapter three is no heading",
             "Part 2 of these words is prose", "Prologue\r", "preface\t", " Epilogue", "", "", "x" * 1200,
             "prose of some words.", "\U0001f600 é", "Kapitel 12 – Das Ende"]
    made = ["\n".join(rng.choices(lines, k=rng.randint(1, 30))) for _ in range(300)]
    return [*filter(None, made), "\n", "\n\n# a", "# a", "# a\n", "# a\n# a\n", "no line end", "\r\n# b\r\n", "y" * 2000]


HEADING = (
    r"#{1,6}[ \t]+[^\n]{1,200}|(?i:chapter|chapitre|kapitel|part)[ \t]+(?:\d{1,4}|[IVXLCDM]{1,8})"
    r"(?:[ \t]*[.:–—-][^\n]{0,100})?|(?i:prologue|epilogue|preface)"
)


def test_against_lines(spark, texts):
    docs = spark.createDataFrame([*enumerate(texts), (None, "# a"), (None, None), (-1, "")], "id int, text string")
    found = {}
    for r in chapters.chapter_chunks(docs).collect():
        found.setdefault(r["id"], []).append((r.chapter_no, r.chapter, r.chunk_no, r.location, r.chunk))
    assert found.pop(None) == [(0, "a", 0, 0, "# a")]
    assert set(found) == set(range(len(texts)))
    for i, text in enumerate(texts):
        rows = sorted(found[i], key=lambda r: (r[0], r[2]))
        assert "".join(r[4] for r in rows) == text
        assert rows == plain(text, HEADING)


def test_columns_of_the_same_names_and_repeated_rows(spark):
    docs = spark.createDataFrame([("s", "r", "# T\nx", 5)] * 2, "section string, row string, text string, `a.b` int")
    rows = chapters.chapter_chunks(docs).collect()
    assert [tuple(r) for r in rows] == [("s", "r", 5, 0, "T", 0, 0, "# T\nx")] * 2
    assert chapters.chapter_chunks(docs.where("false")).count() == 0


def test_stays_within_a_row(spark):
    docs = spark.range(3).selectExpr("id", "repeat('# h\n', 100000) AS text")
    found = chapters.chapter_chunks(docs)
    assert found.where("chapter = 'h' AND chunk = '# h\n'").count() == 300_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
