"""The audit against a plain cube."""

import random
import re
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, item string, n int, kept string"
LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute(rows, listed):
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().translate(LOW))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    for lang in docs:
        kept = {t for t, n in docs[lang].items() if n >= 3}
        held = {s: {t: c[t] for t in kept} for (l, s), c in counts.items() if l == lang}
        all_ = {t: sum(h[t] for h in held.values()) for t in kept}

        def shares(h):
            total = sum(h.values()) + len(kept)
            return {t: 1 + 10**9 * (h[t] + 1) // total for t in kept}

        p, q = {s: shares(h) for s, h in held.items()}, shares(all_)
        for s in held:
            pairs = [
                (-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in held if o != s
            ]
            terms = [
                (-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if held[s][t] and p[s][t] > q[t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:listed])):
                out |= {(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(found)}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeéß漢", k=rng.randint(1, 4))) for _ in range(60)]
    out = []
    for i in range(120):
        lang, source = rng.choice(["en", "en", "de", None, "xx"]), rng.choice(["a", "b", "ß", "d e", None])
        text = rng.choice([" ", "-1"]).join(rng.choices(words, k=rng.randint(0, 40)))
        out.append((i, text.upper() if i % 7 else text, lang, source, "x", 1, "y"))
    out += [
        (200, "only once", "zz", "a", "x", 1, "y"), (201, None, "zz", "b", "x", 1, "y"),
        (202, "", "en", "empty", "x", 1, "y"), (None, "abc", "yy", "alone", "x", 1, "y"),
    ]
    # a hot source, repeated rows
    return out + [(300, " ".join(words[:20]) * 3, "en", "a", "x", 1, "y")] * 40


@pytest.mark.parametrize("sources, terms, listed", [(16, 16384, 200), (2, 5, 3), (1, 1, 1)])
def test_audit(spark, rows, sources, terms, listed):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = divergence.audit(docs, sources=sources, terms=terms, listed=listed).collect()
    wanted = brute(rows, listed)
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)


def test_no_documents(spark):
    found = divergence.audit(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.count() == 0


def test_pieces_and_batches(monkeypatch, spark, rows):
    monkeypatch.setattr(divergence, "PIECE", 5)
    assert [t for p in divergence._terms("Ab cdé1fgh " * 9) for t in p] == [b"ab", "cdé".encode(), b"fgh"] * 9
