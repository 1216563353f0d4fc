"""Ordered moves carried out step by step on a model of the storage."""

import random

import pytest

from shelfmark.operators import moves

MOVES = "path string, target string, step string"


def done(steps, storage):
    """``storage`` (place: file) after the steps; no move may meet a file, or find none."""
    storage = dict(storage)
    for step in sorted({r["step"] for r in steps if r["dst"]}):
        rows = [r for r in steps if r["step"] == step and r["dst"]]
        before = dict(storage)
        for r in rows:  # in any order: each has to be possible before all others of the step
            assert r["src"] in before and r["dst"] not in before, r
            storage[r["dst"]] = storage.pop(r["src"])
        assert len(storage) == len(before)
    return storage


def brute(wanted, present):
    """Action of each path, by following its chain."""
    wanted = {p: t for p, t in wanted.items() if p in present and t is not None}
    targets = list(wanted.values())

    def first(p):
        if p not in wanted or wanted[p] == p:
            return "stay"
        return "claimed" if targets.count(wanted[p]) > 1 else "move"

    out = {}
    for p in wanted:
        out[p] = first(p)
        seen, at = {p}, wanted[p]
        while out[p] == "move" and at in present and at not in seen:
            if first(at) != "move":
                out[p] = "occupied"
            seen.add(at)
            at = wanted.get(at)
    return out


def run(spark, wanted, present, name):
    steps = moves.ordered(
        spark.createDataFrame([(p, t, "clash") for p, t in wanted.items()], MOVES),
        spark.createDataFrame([(p, 1) for p in present], "path string, root int"), name,
    )
    return steps, steps.collect()


def check(spark, wanted, present, name):
    steps, rows = run(spark, wanted, present, name)
    storage = {p: p for p in present}
    after = done(rows, storage)
    actions = {r["path"]: "move" if r["dst"] else r["action"] for r in rows}
    assert actions == brute(wanted, present)
    expected = {(wanted[p] if actions.get(p) == "move" else p): p for p in present}
    assert after == expected
    back = moves.inverse(steps).collect()
    assert done(back, after) == storage
    net = {r["src"]: r["dst"] for r in moves.net(steps).collect()}
    assert net == {p: wanted[p] for p, a in actions.items() if a == "move"}
    return rows


def test_chain_swap_ring_and_conflicts(spark):
    wanted = {
        "a": "b", "b": "c", "c": "new",  # a chain into a free place
        "s": "t", "t": "s",  # a swap
        "x": "y", "y": "z", "z": "x",  # a ring
        "p": "q", "q": "stays", "stays": "stays",  # behind a file that stays
        "m": "one", "n": "one",  # claimed twice
        "o": "m",  # behind a claimed one
        "u": "unplanned",  # a file lies there that no one moves
        "gone": "free", "null": None,
    }
    present = (set(wanted) - {"gone"}) | {"unplanned"}
    rows = check(spark, wanted, present, "test-moves")
    action = {r["path"]: r["action"] for r in rows if r["action"] != "back"}
    assert [action[p] for p in "abcstxyz"] == ["move"] * 3 + ["aside", "move", "aside"] + ["move"] * 2
    # q wants the place that a file wants which lies there
    assert [action[p] for p in "pqmnou"] == ["occupied"] + ["claimed"] * 3 + ["occupied"] * 2
    assert "gone" not in action and "null" not in action
    assert {r["path"]: (r["step"], r["last_step"]) for r in rows if r["path"] in ("a", "b", "c")} == {
        "c": (0, 2), "b": (1, 2), "a": (2, 2)}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    places = [f"/p{i}" for i in range(120)]
    present = set(rng.sample(places, 90))
    targets = rng.sample(places, 90)  # mostly claimed once
    wanted = dict(zip(sorted(present), targets))
    for p in rng.sample(sorted(wanted), 8):
        wanted[p] = rng.choice(places)
    check(spark, wanted, present, f"test-moves-{seed}")


def test_a_long_chain_takes_few_rounds(spark):
    """A series renumbered by one, and a ring of 300."""
    wanted = {f"/v/{i:04}": f"/v/{i + 1:04}" for i in range(700)}
    wanted |= {f"/w/{i:04}": f"/w/{(i + 1) % 300:04}" for i in range(300)}
    rows = check(spark, wanted, set(wanted), "test-moves-long")
    assert max(r["step"] for r in rows) == 699 and len(rows) == 1001


def test_nothing_to_move(spark):
    steps, rows = run(spark, {}, set(), "test-moves-none")
    assert rows == [] and moves.inverse(steps).isEmpty()
