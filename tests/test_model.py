"""Random histories of a library, scan by scan, against a plain account of them."""

import hashlib
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from shelfmark.plans.rescan import rescan
from shelfmark.sources.store import Catalog

NAMES = ["a.epub", "b.MOBI", "c.jpg", "d", "e.mp3", "f.pdf", "g.zip", "h.tan"]
FOLDERS = ["", "Fiction/", "AudioBooks/x/", "Client/"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_history(spark, tmp_path, seed):
    dice = random.Random(seed)
    base = tmp_path / "lib"
    base.mkdir()
    on_disk, stored, now = {}, {}, datetime(2024, 1, 1, tzinfo=timezone.utc)
    for step in range(5):
        for _ in range(dice.randint(3, 8)):
            rel = dice.choice(FOLDERS) + dice.choice(NAMES)
            place = base / rel
            if rel in on_disk and dice.random() < 0.4:
                place.unlink()
                del on_disk[rel]
            else:
                place.parent.mkdir(parents=True, exist_ok=True)
                data = bytes([dice.randrange(4)]) * dice.randrange(1, 4)
                place.write_bytes(data)
                on_disk[rel] = data
        prune = dice.random() < 0.3
        now += timedelta(days=1)
        result = rescan(
            spark, str(tmp_path / "cat"), [str(base)], prune=prune, now=now, log=lambda *_: None
        )

        missing = set(stored) - set(on_disk)
        fresh = 0
        for rel, data in on_disk.items():
            sidecar = rel.endswith((".jpg", ".tan"))
            signature = (len(data), (base / rel).stat().st_mtime)
            old = stored.get(rel)
            if not sidecar and (old is None or old["signature"] != signature):
                fresh += 1
            stored[rel] = {
                "signature": signature, "sha": None if sidecar else hashlib.sha256(data).hexdigest(),
                "first": old["first"] if old else now, "last": now, "gone": None,
            }
        for rel in missing:
            if prune:
                del stored[rel]
            else:
                stored[rel]["gone"] = stored[rel]["gone"] or now

        assert result["missing"] == len(missing)
        assert result["pruned"] == (len(missing) if prune else 0)
        assert result["files_hashed_this_run"] == fresh
        assert result["files_seen"] == len(on_disk)
        copies = Counter(r["sha"] for r in stored.values() if r["sha"])
        groups = [n for n in copies.values() if n > 1]
        assert (result["duplicate_groups"], result["files_in_dup_groups"]) == (len(groups), sum(groups))
        rows = Catalog(spark, str(tmp_path / "cat")).files().collect()
        plain = lambda t: t and t.replace(tzinfo=None)
        assert {r["rel_path"]: (
            (r["size_bytes"], r["mtime"]), r["sha256"], r["first_seen"], r["last_seen"],
            r["missing_since"],
        ) for r in rows} == {rel: (
            e["signature"], e["sha"], plain(e["first"]), plain(e["last"]), plain(e["gone"]),
        ) for rel, e in stored.items()}
        assert len({r["id"] for r in rows}) == len(rows)
