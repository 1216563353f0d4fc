"""Near titles against all pairs, with a hot name and a chain."""

import itertools
import random

import pytest

from shelfmark.operators import near_titles


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def digits(name):
    return " ".join("".join(c if c.isdigit() else " " for c in name).split())


def brute(rows, most):
    members = {}
    for path, shelf, _, title, size in rows:
        members.setdefault((shelf, title, len(bin(size)) - 2), []).append(path)
    nodes = list(members)
    links = {n: set() for n in nodes}
    for a, b in itertools.combinations(nodes, 2):
        if a[0] == b[0] and digits(a[1]) == digits(b[1]) and abs(a[2] - b[2]) <= 1 and (
            a[1] == b[1] or (min(len(a[1]), len(b[1])) >= 5 and edits(a[1], b[1]) <= most)
        ):
            links[a].add(b)
            links[b].add(a)
    out = {}
    for n in nodes:
        seen, todo = {n}, [n]
        while todo:
            for o in links[todo.pop()] - seen:
                seen.add(o)
                todo.append(o)
        files = [p for s in seen for p in members[s]]
        if len(files) > 1:
            for p in members[n]:
                out[p] = (min(files), len(files), len(links[n]))
    return out


@pytest.mark.parametrize("most", [1, 2])
def test_near_duplicates(spark, most):
    rng = random.Random(8)
    names = ["otters of the north", "rivers", "a tale 12", "a tale 13", "tiny", "tine", "", "chain aaaaa"]
    names += ["chain" + " aaaaa"[: 6 - i] + "b" * i for i in range(6)]
    rows = []
    for i in range(160):
        name = rng.choice(names)
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(name) + 1)
            name = name[:at] + rng.choice("abc") + name[at + rng.choice([0, 1]) :]
        rows.append((f"/p{i:03}", rng.choice(["fiction", "other"]), "", name, rng.choice([0, 900, 1100, 5000])))
    # one name that many files have
    rows += [(f"/hot{i}", "fiction", "", "untitled", 1000) for i in range(300)]
    rows.append(("/hot-near", "fiction", "", "untitlet", 2000))
    files = spark.createDataFrame(
        rows, "path string, shelf string, author_key string, title_key string, size_bytes long"
    ).selectExpr("*", "timestamp(NULL) AS missing_since", "1 AS rag_eligible", "string(NULL) AS keeper")
    # names are trimmed
    wanted = brute([(p, s, a, t.strip(), n) for p, s, a, t, n in rows], most)
    found = near_titles.near_duplicates(files, f"test-near/{most}", most)
    assert {r.path: (r.keeper, r.files, r["links"]) for r in found.collect()} == wanted
    assert wanted["/hot-near"] == ("/hot-near", 301, 1)
    # the name of many files is posted once
    nodes = near_titles.nodes(files)
    assert near_titles.links(nodes, most).count() <= 40 * nodes.count()


def test_none(spark):
    files = spark.createDataFrame(
        [], "path string, shelf string, author_key string, title_key string, size_bytes long,"
        " missing_since timestamp, rag_eligible int, keeper string",
    )
    assert near_titles.near_duplicates(files, "test-near/none").count() == 0
