"""Size of archives, the directory's binary search, and look-ups against a walk over all urls."""

import bisect
import random
from pathlib import Path

from shelfmark.llm import warc


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 20_000)
    rng = random.Random(1)
    sizes = [*[50_000] * 2, *[6_000] * 40, *[10] * 1000]
    rows = [(i, f"http://h{i % 7}.org/{i}", chr(97 + i % 26) + "".join(rng.choices("é\nx", k=n)))
            for i, n in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write(pages, str(tmp_path / "w"))
    files = [p.read_bytes() for p in Path(tmp_path / "w").glob("part-*")]
    large = [f for f in files if len(f) > 20_000]
    assert len(large) == 2 and all(f.count(b"WARC-Type: response") == 1 for f in large)
    assert len(files) < 45 and all(f.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") for f in files)
    warc.index(spark, str(tmp_path / "w"), str(tmp_path / "i"))
    found = warc.lookup(spark, str(tmp_path / "i"), pages.select("url")).collect()
    assert sorted((int(r.id), r.url, r.payload) for r in found) == rows


def test_places(monkeypatch):
    monkeypatch.setattr(warc, "KEY_CHARS", 3)
    rng = random.Random(4)
    for _ in range(300):
        keys = sorted("".join(rng.choices("abé", k=rng.randint(0, 6))) for _ in range(rng.randint(1, 40)))
        keys += [keys[-1]] * rng.randint(0, 9)
        blocks = [keys[i : i + 4] for i in range(0, len(keys), 4)]
        firsts = [b[0][:3] for b in blocks]
        for key in [*keys, "", "b", "zz", "ab"]:
            held = {i for i, b in enumerate(blocks) if b[bisect.bisect_left(b, key) :][:1] == [key]}
            assert held <= set(warc.places(firsts, key))
    assert list(warc.places([], "a")) == []
    assert list(warc.places(["a", "c", "e"], "d")) == [1]


def test_lookup_by_many_blocks(spark, tmp_path, monkeypatch):
    """A third of all captures have one url; blocks are longer where there would be too many."""
    monkeypatch.setattr(warc, "LINES", 10)
    monkeypatch.setattr(warc, "BLOCKS", 40)
    hot = "http://hot.org/" + "x" * 400
    urls = [hot if i % 3 == 0 else f"https://H{i % 5}.example.org:80/{i}?q=é#f" for i in range(900)]
    urls += [None, None, "no scheme"]
    pages = spark.createDataFrame([*enumerate(urls)], "page_id long, url string").selectExpr("*", "string(page_id) AS html")
    warc.write(pages, str(tmp_path / "w"))
    warc.index(spark, str(tmp_path / "w"), str(tmp_path / "i"))
    directory = spark.read.parquet(str(tmp_path / "i/directory"))
    assert 20 < directory.count() <= 40 and max(len(r.first) for r in directory.collect()) <= warc.KEY_CHARS

    def ids(wanted):
        return sorted(int(r.id) for r in warc.lookup(spark, str(tmp_path / "i"), wanted).collect())

    assert ids([hot, hot]) == list(range(0, 900, 3))
    assert ids(["http://h4.EXAMPLE.org:80/4?q=é", "http://nowhere/", hot[:-1]]) == [4]
    assert ids([None]) == [900, 901, 902]  # what has no host has the same key
    assert ids([]) == []
    assert ids(pages.select("url")) == list(range(903))
