"""Spelling variants against all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from shelfmark.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, key string"
LOW = {c: c + 32 for c in range(65, 91)}


def words_of(rows):
    out = Counter()
    for id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 97 == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = words_of(rows)
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    stems = ["".join(rng.choices("abcdéñ÷", k=rng.randint(4, 12))) for _ in range(40)]
    texts = []
    for _ in range(300):
        stem = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            at = rng.randint(0, len(stem))
            stem = stem[:at] + rng.choice(["", "a", "é"]) + stem[at + rng.choice([0, 1]) :]
        texts.append(f"{stem} {stem.upper()}, {stem}" if stem.isascii() else f"{stem}\n{stem} {stem}")
    # a hot group: words that share all but a few letters, and runs of one letter
    hot = ["commonstem" + "".join(p) + "tail" for p in itertools.product("abcdefg", repeat=2)]
    texts += [" ".join([w] * rng.randint(3, 9)) for w in hot + ["aaaaa", "aaaaaa", "aaaaaaa", "baaaaa"]]
    texts += [None, "", "12 漢字 ab", "longest" * 2000 + " " + "longest" * 2000 + "s"] + ["longest" * 2000] * 3
    out = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    return out + [(None, "nullid nullid nullid", "x", 1, "y"), out[0], out[0]]


@pytest.mark.parametrize("many", [2, 32])
def test_variants(spark, rows, many, monkeypatch):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = spelling.variants(docs, many=many).collect()
    wanted = brute(rows)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == wanted
    assert len(found) == len(wanted) and any(v[0] for v in wanted.values())


def test_no_documents(spark):
    found = spelling.variants(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found.count() == 0


def test_pieces_of_a_long_text(monkeypatch):
    text = "Ab cdé'fgh ijk " * 50
    whole = spelling._runs(text)
    monkeypatch.setattr(spelling, "PIECE", 7)
    assert spelling._runs(text) == whole


def test_a_hot_group_is_not_squared(spark):
    """4,000 words of one long stem: what is compared stays near-linear in the words."""
    rng = random.Random(0)
    stem = "s" * 12
    found = {stem + "".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(4000)}
    words = spark.createDataFrame([(w,) for w in found], "word string")
    near = spelling.near_words(words)
    wanted = set()
    for w in found:
        for i in range(len(w)):
            for c in "abcdefghijklmnop":
                other = w[:i] + c + w[i + 1 :]
                if other != w and other in found:
                    wanted.add((min(w, other), max(w, other)))
    assert {(r.a, r.b) for r in near.collect()} == wanted
