"""Passages against all runs of words, rows that share an id, values that many documents hold."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import substrings
from shelfmark.llm.substrings import SHINGLE, WORDS

SCHEMA = "doc_id long, text string, row string, begin int, other string"
LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return (text or "").encode().translate(LOW).split()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdeéß漢", k=rng.randint(2, 8))) for _ in range(600)]

    def prose(n):
        return rng.choices(vocabulary, k=n)

    passages = [prose(rng.randint(50, 120)) for _ in range(8)]
    boiler = prose(55)
    out = []
    for i in range(60):
        held = prose(rng.randint(0, 80))
        for _ in range(rng.choice([0, 1, 2])):
            held += rng.choice(passages) + prose(rng.randint(5, 60))
        if i % 2:  # a hot value: half of the documents
            held += boiler
        text = " ".join(held)
        out.append((rng.randint(0, 1000), text.upper() if text.isascii() else text, "x", 1, "y"))
    near = list(passages[0])
    near[len(near) // 2] = "changed"
    out += [
        (2000, " ".join(near), "x", 1, "y"), (2001, None, "x", 1, "y"), (2002, "", "x", 1, "y"),
        (None, " ".join(passages[1]), "x", 1, "y"), (None, " ".join(prose(70)), "x", 1, "y"),
        (2003, " ".join(prose(6000)), "x", 1, "y"), (2003, " ".join(passages[2]), "x", 1, "y"),
    ]
    return out + [out[5], out[5]]


def ordered(spark, rows):
    """Distinct (id, text), in the operator's order."""
    found = spark.createDataFrame(rows, SCHEMA).select(
        "doc_id", "text", F.xxhash64("text").alias("hash")
    ).distinct().collect()
    return sorted(found, key=lambda r: (r.doc_id is not None, r.doc_id, r.hash))


def test_against_all_runs(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = substrings._spans(docs, "doc_id", "text").collect()
    spans = {}
    for r in found:
        spans.setdefault((r.row.id, r.row.hash), []).append((r.begin, r.end, (r.first.id, r.first.hash)))
    seen, tokens = {}, {}
    order = ordered(spark, rows)
    missed = whole = 0
    for k, r in enumerate(order):
        w = tokens[r.doc_id, r.hash] = words(r.text)
        covered = np.zeros(len(w), bool)
        for begin, end, _ in spans.get((r.doc_id, r.hash), []):
            covered[begin:end] = True
        for i in range(len(w) - WORDS + 1):
            run = tuple(w[i : i + WORDS])
            if run in seen and seen[run] < k:
                whole += 1
                missed += not covered[i : i + WORDS].all()
            seen.setdefault(run, k)
    # a run that reaches one word beyond a passage by chance may be in a document that is met
    # neither as the first holder of a value nor as the nearest
    assert whole > 1000 and missed <= whole // 1000
    # what is listed resembles a run of the earlier document
    place = {(r.doc_id, r.hash): k for k, r in enumerate(order)}
    for key, own in spans.items():
        for begin, end, first in own:
            assert place[first] < place[key] and end - begin >= WORDS
            mine = shingles(tokens[key][begin:end])
            b = tokens[first]
            assert any(
                alike(mine, shingles(b[i : i + n]))
                for n in (end - begin, end - begin - 1, end - begin + 1) for i in range(len(b) - n + 1)
            ) or any(
                alike(mine, shingles(b[i:j]))
                for i in range(len(b)) for j in range(i + WORDS // 2, min(len(b), i + 2 * (end - begin)) + 1)
            )
    assert (2000, next(r.hash for r in order if r.doc_id == 2000)) in spans  # the near copy


@pytest.mark.parametrize("posted", [1, 4])
def test_no_run_is_lost(spark, rows, monkeypatch, posted):
    """Every run of WORDS words that an earlier document holds lies in a passage, whichever of
    the documents under its values holds it."""
    rng = random.Random(5)
    few = [f"w{i}" for i in range(40)]
    line = rng.choices(few, k=6)
    hot = [(3000 + i, " ".join(rng.choices(few, k=60) + line + rng.choices(few, k=60)), "x", 1, "y") for i in range(60)]
    # the passages of some in the middle come again, among others under the same values
    again = [(4000 + i, " ".join(rng.choices(few, k=30) + hot[i][1].split()[20:110]), "x", 1, "y") for i in range(5, 55)]
    monkeypatch.setattr(substrings, "POSTED", posted)
    rows = rows + hot + again
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    spans, seen, missed, whole = {}, {}, 0, 0
    for r in substrings._spans(docs, "doc_id", "text").collect():
        spans.setdefault((r.row.id, r.row.hash), []).append((r.begin, r.end))
    for k, r in enumerate(ordered(spark, rows)):
        w = words(r.text)
        for i in range(len(w) - WORDS + 1):
            run = tuple(w[i : i + WORDS])
            if seen.setdefault(run, k) < k:
                whole += 1
                missed += not any(a <= i and i + WORDS <= b for a, b in spans.get((r.doc_id, r.hash), []))
    assert whole > 4000 and not missed


def shingles(w):
    return {tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}


def alike(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


def test_rows_with_one_id_are_cut_apart(spark):
    rng = random.Random(1)
    passage, own, other = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (60, 120, 90))
    rows = [(1, other + " " + passage, "", 0, ""), (2, passage + " tail", "", 0, ""), (2, own, "", 0, ""),
            (None, own, "", 0, ""), (3, passage, "", 0, ""), (3, passage, "", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = [(r.doc_id, r.text.strip()) for r in substrings.without_repeats(docs).collect()]
    assert sorted(left, key=str) == sorted(
        [(1, other + " " + passage), (2, "tail"), (2, ""), (None, own), (3, ""), (3, "")], key=str
    )


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pairs_do_not_depend_on_batches(size):
    rng = random.Random(size)
    found = sorted((rng.randrange(6), rng.choice([None, *range(9)]) or -1, rng.randrange(3), rng.randrange(50))
                   for _ in range(200))
    kind = pa.struct([("id", pa.int64()), ("hash", pa.int64())])
    row = [{"id": None if i == -1 else i, "hash": h} for _, i, h, _ in found]
    table = pa.table({
        "key": [k * 8 for k, *_ in found], "row": pa.array(row, kind),
        "l": pa.array([p for *_, p in found], pa.int32()), "r": pa.array([p + 50 for *_, p in found], pa.int32()),
        "other": pa.array([None] * len(found), kind),
        "hl": pa.array([0] * len(found), pa.int32()), "hr": pa.array([0] * len(found), pa.int32()),
    })
    got = [
        (str(x["row"]), str(x["other"]), x["l"], x["hl"])
        for b in substrings._met_in_order(table.to_batches(max_chunksize=size)) for x in b.to_pylist()
    ]
    wanted = []
    for k, i, h, p in found:
        under = [x for x in found if x[0] == k]
        before = sorted({x[1:3] for x in under if x[1:3] < (i, h)})
        for doc in {before[0], before[-1]} if before else ():
            head = min(x[3] for x in under if x[1:3] == doc)
            name = [str({"id": None if a == -1 else a, "hash": b}) for a, b in ((i, h), doc)]
            wanted.append((*name, p, head))
    assert sorted(got) == sorted(wanted)


@pytest.mark.parametrize("width", [1, 3, 46])
def test_windows_of_several_texts(width):
    """As of each text by itself, with ties, slopes and texts shorter than a window."""
    rng = np.random.Generator(np.random.PCG64(5))
    held = [rng.integers(0, k, n).astype(np.uint64) for n in (0, 1, 45, 46, 47, 400) for k in (1, 3, 10**9)]
    held += [np.arange(300, dtype=np.uint64), np.arange(300, 0, -1).astype(np.uint64)]
    ends = np.cumsum([len(x) for x in held])
    begins = ends - [len(x) for x in held]
    text, *places = substrings.wide_windows(np.concatenate(held), ends, width)
    found = sorted(zip(text.tolist(), *((x - begins[text]).tolist() for x in places)))
    assert found == sorted(
        (i, *x) for i, values in enumerate(held) for x in substrings._windows_by_stack(values.tolist(), width)
    )


@pytest.mark.parametrize("together", [1, 500, 1 << 16])
def test_windows_do_not_depend_on_parts(rows, monkeypatch, together):
    kind = pa.struct([("id", pa.int64()), ("hash", pa.int64())])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([{"id": r[0], "hash": i} for i, r in enumerate(rows)], kind), pa.array([r[1] for r in rows])],
        names=["row", "text"],
    )
    whole = list(substrings._posted([batch]))
    monkeypatch.setattr(substrings, "TOGETHER", together)
    monkeypatch.setattr(substrings, "READ", together)
    assert sum(map(len, whole)) > 100 and all(x.equals(y) for x, y in zip(whole, substrings._posted([batch]), strict=True))


def test_runs_are_not_compared_where_too_little_is_in_common(monkeypatch):
    """Ends in common and a third between them: no run of the other can be similar."""
    a = np.arange(300, dtype=np.int32)
    b = np.where((a % 3 == 0) | (a < 5) | (a > 294), a, a + 1000).astype(np.int32)
    near = np.where(a % 30, a, a + 1000).astype(np.int32)
    asked = []
    runs = substrings._runs
    monkeypatch.setattr(substrings, "_runs", lambda *x: asked.append(x) or runs(*x))
    assert substrings.passages(a, b) == [] and not asked
    assert substrings.passages(a, near) == [(1, 300)]
