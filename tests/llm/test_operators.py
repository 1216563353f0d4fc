"""Each operator against brute force or the public library, over awkward rows."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer, models, normalizers

from shelfmark.llm import (
    bpe, class_lm, fm_index, id_store, near_dedup, quality, substrings, unigram, url_rules, warc,
)

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, kept string"


def words(text):
    return (text or "").encode().translate(LOW).split()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdeéßñ漢", k=rng.randint(1, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    passage, base = prose(60), prose(200)
    near = base.split(" ")
    near[20] = "changed"
    out = [
        None, "", " \n\t ", "one", "One two THREE", "a b  c\n\n d", "x" * 3000, "the " * 400,
        "don't 'tis 12,5%\r\n　end ", base, base, base.encode().upper().decode(), " ".join(near), prose(5000),
        prose(80) + " " + passage + " " + prose(80), prose(90) + "\n" + passage + ". " + prose(40),
        passage, "▁mark ▁▁ and  spaces", "<|endoftext|> text", "\U0001f600 \x1c\x85 é",
    ]
    return out + [prose(rng.randint(1, 120)) for _ in range(30)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(docs, none, texts):
    def shingles(text):
        w = words(text)
        return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())

    sets = list(map(shingles, texts))
    root = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    found = near_dedup.near_duplicates(docs, shingle=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        i: (len(s), root[i], root[i] == i) for i, s in enumerate(sets)
    }
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_of_a_large_family(spark):
    """A hub of copies and near copies, with members that link only through others."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for k in rng.sample(range(120), rng.choice([0, 0, 1, 2, 3, 6])):
            w[k] = f"z{i}_{k}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(w[k : k + 5]) for k in range(116)} for w in (t.split() for _, t in rows)]
    root = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if root[i] > root[j] and 100 * len(a & b) >= 80 * len(a | b):
                    root[i], changed = root[j], True
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(root))

def test_near_duplicates_of_one_template(spark, monkeypatch):
    """Texts of one template whose changes coincide: few whose similarity is too small are compared."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    base = rng.choices(vocabulary, k=150)
    rows = []
    for i in range(240):
        w = list(base)
        for k in rng.sample(range(150), rng.randint(0, 10)):
            w[k] = rng.choice(vocabulary[:8])
        rows.append((i, " ".join(w)))
    sets = [{tuple(w[k : k + 4]) for k in range(147)} for w in (t.split() for _, t in rows)]
    alike = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if 100 * len(a & b) >= 80 * len(a | b)}
    root, before = list(range(len(sets))), None
    while root != before:
        before = list(root)
        for i, j in alike:
            root[i] = root[j] = min(root[i], root[j])
    compared = []

    def counted(df, name, staged=near_dedup.staged):
        out = staged(df, name)
        if name == "close":
            compared.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "staged", counted)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(root))
    assert len(set(root)) > 40 and sum(compared) < 1000


def test_sketches_never_tell_more_apart():
    rng = np.random.Generator(np.random.PCG64(1))
    for n in (0, 1, 50, 3000, 20_000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.append(a[n // 3 :], rng.integers(0, 1 << 63, n // 4, dtype=np.uint64))
        apart = np.unpackbits((near_dedup._sketch(a) ^ near_dedup._sketch(b)).view(np.uint8)).sum()
        assert apart <= n // 3 + n // 4 and (apart > 0) == (n > 2)


def test_substrings(docs, none, texts):
    found = {(r.doc_id, r.first_id): (r.begin, r.end) for r in substrings.repeats(docs).collect()}
    assert found[15, 14] == (90, 150) or found[15, 14] == (90, 149)  # its last word has a stop
    assert found[10, 9] == found[11, 9] == (0, 200)
    assert (12, 9) in found and not any(d in (0, 1, 2, 3, 13) or d > 19 for d, _ in found)
    left = {r.doc_id: r.text for r in substrings.without_repeats(docs).collect()}
    assert len(left) == len(texts) and left[9] == texts[9] and left[0] is None
    assert not left[10].strip() and texts[16][:40] not in left[15] and texts[16] in left[14]
    assert substrings.repeats(none).count() == substrings.without_repeats(none).count() == 0


@pytest.mark.parametrize("distinct", [3, 1000])
def test_compact_windows(distinct):
    values = np.random.default_rng(0).integers(0, distinct, 300, dtype=np.uint64)
    found = substrings.compact_windows(values, 20)
    assert sorted(found) == sorted(substrings._windows_by_stack(values.tolist(), 20))
    for i in range(0, 280):
        c = i + int(values[i : i + 20].argmin())
        assert sum(l <= i and i + 19 <= r and k == c for l, k, r in found) == 1


def test_byte_bpe(docs, none, texts):
    path = public.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(docs, path, public.PATTERN)
    ids = {r.doc_id: r.ids for r in coded.collect()}
    assert ids == {i: own.encode_ordinary(t or "") for i, t in enumerate(texts)}
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(coded, path, public.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}
    digests = bpe.round_trip(docs, path, public.PATTERN).collect()
    for r in digests:
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back[r.doc_id]).hexdigest()
    assert bpe.encode(none, path, public.PATTERN).count() == 0


def test_id_store(spark, docs, none, texts, tmp_path):
    path = public.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    ids = [own.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    id_store.write(docs, str(tmp_path / "store"), path)
    start = 0
    found = {r.doc_id: r for r in id_store.read(spark, str(tmp_path / "store")).collect()}
    for i, x in enumerate(ids):
        data = np.array(x, "<u4").tobytes()
        r = found[i]
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.data)) == (start, len(x), zlib.crc32(data), data)
        start += len(x)
    some = {r.doc_id: bytes(r.data) for r in id_store.fetch(spark, str(tmp_path / "store"), [3, 9, 77]).collect()}
    assert some == {i: np.array(ids[i], "<u4").tobytes() for i in (3, 9)}
    assert id_store.write_and_read(none, path).count() == 0


def test_url_rules(spark):
    rows = [
        ("https://a.example.org/es/1", "example.org/es/", "block"), ("http://EXAMPLE.org/en/1x", "example.org/en/1", "block"),
        ("http://x.org", None, "allow"), ("http://x.org/", "org/", "allow"), ("http://a.com/de/", "com/de/", "block"),
        ("http://adult-x.b.net/", None, "block"), ("http://badult-x.b.net/", None, "allow"), (None, None, "allow"),
        ("no scheme", None, "allow"), ("http://b.net/ads/1", None, "block"), ("http://b.net/x.EXE", None, "block"),
        ("http://b.net/x.exe", None, "block"), ("http://b.net/x.exec", None, "allow"), ("http://b.net/?affiliate=1", None, "block"),
    ] * 2
    pages = spark.createDataFrame([(i, u, "h") for i, (u, _, _) in enumerate(rows)], "page_id long, url string, host string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_rules.verdicts(pages).collect()}
    assert found == {i: x[1:] for i, x in enumerate(rows)}
    only = url_rules.verdicts(pages, (), ("xe",)).where("verdict = 'block'")  # no literal token
    assert only.count() == 6
    assert url_rules.verdicts(pages.limit(0)).count() == 0


def test_class_lm(docs, none, texts):
    found = {r.doc_id: r for r in class_lm.scores(docs, "doc_id % 7 = 2").collect()}
    tokens = [[*words(t), None] for t in texts]
    counts = Counter(w for i, t in enumerate(tokens) if i % 7 != 2 for w in t)
    total, kinds = sum(counts.values()), len(counts)
    for i, t in enumerate(tokens):
        r = found[i]
        assert (r.n_tokens, r.train_tokens) == (len(t), total)
        assert r.n_known == sum(counts[w] > 0 for w in t) and r.held_out == (i % 7 == 2)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in t), rel_tol=1e-9)
        assert math.isclose(r.perplexity, 10 ** (-r.score / len(t)))
    assert class_lm.scores(none, "false").count() == 0
    assert {r.base_score for r in class_lm.scores(docs, "true").collect()} == {0.0}


def test_class_lm_rare_words_are_joined(docs, monkeypatch):
    whole = {r.doc_id: (r.n_known, r.base_score) for r in class_lm.scores(docs, "doc_id % 7 = 2").collect()}
    monkeypatch.setattr(class_lm, "LOOKUP", 50)
    for r in class_lm.scores(docs, "doc_id % 7 = 2").collect():
        assert r.n_known == whole[r.doc_id][0] and math.isclose(r.base_score, whole[r.doc_id][1])


def test_class_lm_places_a_word_where_the_likelihood_rises_most():
    """Against the likelihood of the table with the word in each class by turns."""
    rng = np.random.Generator(np.random.PCG64(3))
    S, other, width = class_lm.STATES, class_lm.CLASSES, class_lm.STATES + 1
    codes, table = [], rng.integers(0, 40, (S, S))
    for k in range(60):
        some = rng.integers(0, S, 4)  # few neighbours, so that some are on both sides
        n = int(rng.integers(1, 30))
        x, y = rng.choice(some, n), rng.choice(some, n)
        if k % 3 == 0 and n > 2:
            x[0] = y[1] = other
            x[2], y[0] = S, S  # once after itself
        codes.append((x * width + y).astype(np.int16))
    for c in codes:
        x, y = np.divmod(c.astype(int), width)
        for v, w in zip(x, y):
            if v < S:
                table[v, other] += 1
            if w < S:
                table[other, w] += 1
        table[other, other] += (x == S).sum()

    def likelihood(t):
        return class_lm._plogp(t).sum() - class_lm._plogp(t.sum(0)).sum() - class_lm._plogp(t.sum(1)).sum()

    wanted = []
    for c in codes:
        x, y = np.divmod(c.astype(int), width)
        found = []
        for state in [*range(other), other]:
            t = table.astype(float)
            for home, step in ((other, -1), (state, 1)):
                np.add.at(t, (x[x < S], home), step)
                np.add.at(t, (home, y[y < S]), step)
                t[home, home] += step * (x == S).sum()
            found.append(likelihood(t))
        wanted.append(int(np.argmax(found)))
    assert len(set(wanted)) > 10
    # a word's rows may lie in several batches
    parts = [(k, 7, x.tobytes()) for k, c in enumerate(codes) for x in (c[: len(c) // 2], c[len(c) // 2 :])]
    for size in (1, 7, 1000):
        given = pa.table({"a": [x[0] for x in parts], "b": [x[1] for x in parts], "around": pa.array([x[2] for x in parts], pa.binary())})
        broadcast = type("Broadcast", (), {"value": table.tolist()})
        out = pa.Table.from_batches(list(class_lm._placed(given.to_batches(max_chunksize=size), broadcast)))
        assert out["a"].to_pylist() == list(range(60)) and out["n"].to_pylist() == [len(c) for c in codes]
        assert out["state"].to_pylist() == wanted


@pytest.mark.parametrize("lookup", [1_000_000, 3_000])
def test_class_lm_clusters_all_words(spark, monkeypatch, lookup):
    """Words beyond the most frequent ones are told apart by their neighbours, looked up or joined."""
    rng = random.Random(2)
    sides = [[f"{side}{i}" for i in range(2300)] for side in "xy"]
    lines = [f"{side} {w} {side * 2}" for side, held in zip("xy", sides) for w in held[:2000] for _ in range(rng.randint(3, 6))]
    lines += [f"{side} {w} {side * 2}" for side, held in zip("xy", sides) for w in held[2000:] for _ in range(2)]
    rng.shuffle(lines)
    rows = [(i, t) for i, t in enumerate(lines)]
    rows += [(-1, "x x2200 xx"), (-2, "x y2200 xx"), (-3, "x unseen xx"), (-4, "unseen"), (-5, None)]
    monkeypatch.setattr(class_lm, "LOOKUP", lookup)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in class_lm.scores(docs, "doc_id < 0").collect()}
    assert len(found) == len(rows)
    assert found[-1].base_score == found[-2].base_score and found[-1].n_known == found[-2].n_known == 4
    assert found[-1].score > found[-2].score + 1  # equal when all further words were one class
    assert found[-3].n_known == 3 and math.isfinite(found[-3].score) and math.isfinite(found[-4].score)


def test_unigram_counts(docs, none, texts):
    pieces, byte_pieces = unigram.pieces_of(public.path("piece_bpe_32k.model"))
    for fallback in (byte_pieces, False):
        vocabulary = [("<unk>", 0.0), *((f"<0x{i:02X}>", 0.0) for i in range(256 * fallback)), *pieces]
        own = Tokenizer(models.Unigram(vocabulary, 0, fallback))
        own.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
        found = unigram.token_counts(docs, pieces, fallback).collect()
        assert {r.doc_id: r.n_tokens for r in found} == {
            i: len(own.encode(t or "").ids) for i, t in enumerate(texts)
        }
    assert unigram.token_counts(none, pieces, True).count() == 0


@pytest.mark.parametrize("score", [lambda s: s / 10, lambda s: s / 8, lambda s: float(s)], ids=["tenths", "eighths", "whole"])
def test_unigram_scores_that_are_rounded_when_summed(spark, score):
    """Ties are the library's whatever the scores: tenths are rounded in sums, the others never."""
    rng = random.Random(9)
    letters = [(c, -float(rng.randint(10, 14))) for c in "▁abcd"]
    longer = {"".join(rng.choices("abcd", k=rng.randint(2, 4))) for _ in range(60)}
    longer |= {"▁" + "".join(rng.choices("abcd", k=rng.randint(1, 3))) for _ in range(30)}
    pieces = [(p, score(s)) for p, s in letters + [(p, -float(rng.randint(8, 30))) for p in sorted(longer)]]
    assert unigram.Counter(pieces, False).splits == (pieces[0][1] * 8).is_integer()
    own = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    own.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    given = [" ".join("".join(rng.choices("abcdé", [9, 9, 9, 9, 1], k=rng.randint(1, 9))) for _ in range(rng.randint(0, 120)))
             for _ in range(400)] + ["abcd " * 20_000]
    rows = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in unigram.token_counts(rows, pieces, False).collect()}
    assert found == {i: len(own.encode(t).ids) for i, t in enumerate(given)}


def test_unigram_splits_texts_whose_sums_are_exact(monkeypatch):
    pieces, byte_pieces = unigram.pieces_of(public.path("piece_bpe_32k.model"))
    own = unigram.Counter(pieces, byte_pieces)
    assert own.splits and own.most * abs(own.unknown) <= 2**53 < (own.most + 1) * abs(own.unknown)
    assert [unigram.exact_length(s) for s in ([], [-0.1], [-3.0, 0.5])] == [2**53, 0, 2**53 // 6]
    data = np.frombuffer(b"a b ca  bb", np.uint8)
    assert unigram._at_marks(data, np.array([0, 5, 5, 10]), 5).tolist() == [0, 1, 3, 5, 6]
    assert unigram._at_marks(data, np.array([0, 6, 10]), 5).tolist() == [0, 6]
    assert unigram._at_marks(data[:0], np.array([0, 0]), 5).tolist() == []


def test_quality(docs, none, texts):
    found = {r.doc_id: r for r in quality.judge(docs).collect()}
    for i, t in enumerate(texts):
        w = words(t)
        runs = Counter(tuple(w_) for w_ in zip(*(((t or "").encode().split())[k:] for k in range(3))))
        plain = (t or "").encode().split()
        inside = {k + j for k in range(len(plain) - 2) if runs[tuple(plain[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        r = found[i]
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(w), len(inside), len(lines) - len(set(lines)))
        assert r.word_chars == sum(len(x.decode()) for x in plain)
        assert r.n_symbols == sum((t or "").count(c) for c in "#*$%&|<>")
        assert r.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert r.kept == (not r.base_failed)  # too few documents to estimate from
    assert quality.judge(none).count() == 0


def test_quality_rejects_outliers(spark):
    rng = random.Random(3)
    clean = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) for _ in range(rng.randint(60, 300)))) for i in range(80)]
    junk = [(100 + i, " ".join(w + "%%%" for w in t.split())) for i, t in clean[:8]]
    rows = spark.createDataFrame([(i, t, "en", None) for i, t in clean + junk], "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in quality.judge(rows).where("NOT kept").collect()} == {i for i, _ in junk}


def test_warc(spark, tmp_path):
    page = "<p>é\r\n\r\nWARC/1.1</p>" * 60
    rows = [(1, "http://a.org/x", page), (5, "http://b.a.org/y?q=1", page), (3, None, page), (4, "http://c.de/", "short"),
            (6, "http://c.de/", "short"), (7, "http://e.de/\r\nX: 1", None), (None, "http://n.de/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r[1:] for r in warc.round_trip(pages).collect()}
    size, digest = len(page.encode()), hashlib.sha1(page.encode()).hexdigest()
    assert found[5] == (size, digest, "response", None)
    assert found[1] == found[3] == (size, digest, "revisit", 5)
    assert found[4][2] == found[6][2] == "response" and found[7] == (0, hashlib.sha1(b"").hexdigest(), "response", None)
    assert len(found) == len(rows)
    warc.write(pages, str(tmp_path / "w"))
    warc.index(spark, str(tmp_path / "w"), str(tmp_path / "i"))
    hit = warc.lookup(spark, str(tmp_path / "i"), ["http://B.a.org/y?q=1", "http://nowhere/"]).collect()
    assert [(r.id, r.payload) for r in hit] == [("5", page)]
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("block", [fm_index.BLOCK_BYTES, 400])
def test_decontamination(spark, docs, none, texts, monkeypatch, block):
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", block)
    items = [(1, texts[16]), (2, "One two three"), (3, None), (4, "..."), (10, " ".join(texts[13].split(" ")[50:75])), (11, texts[16])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def tokens(text):
        drop = bytes(b for b in range(128) if not chr(b).isalnum())
        return (text or "").encode().translate(LOW).translate(bytes.maketrans(drop, b" " * len(drop))).split(b" ")

    own = [[w for w in tokens(t) if w] for t in texts]
    phrases = []
    for item, t in items:
        w = [x for x in tokens(t) if x]
        phrases += [(w[i : i + 10], item) for i in range(max(1, len(w) - 9))] if w else []
    found = {r.doc_id: r for r in fm_index.occurrences(docs, benchmark).collect()}
    for i, w in enumerate(own):
        hits, who = set(), set()
        for p, item in phrases:
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    hits |= set(range(k, k + len(p)))
                    who.add(str(item))
        r = found[i]
        assert r.n_words == len(w) and r.items == sorted(who)
        assert {k for s in r.spans for k in range(s.begin, s.end)} == hits
    cut = {r.doc_id: r.text for r in fm_index.occurrences(docs, benchmark, cut=True).collect()}
    assert cut[4] == "" and cut[0] is None and cut[9] == texts[9]
    assert fm_index.occurrences(docs, benchmark.limit(0)).where("size(spans) > 0").count() == 0
    assert fm_index.occurrences(none, benchmark).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(5)
    for top in (1, 3, 50):
        text = np.append(rng.integers(1, top + 1, 200), 0)
        assert fm_index.suffix_array(text).tolist() == sorted(range(201), key=lambda i: text[i:].tolist())


def test_quality_judges_small_groups(spark):
    """Junk is rejected by its language's estimate, or that of all documents, where a source is small."""
    rng = random.Random(3)

    def clean():
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) for _ in range(rng.randint(60, 300)))

    def junk():
        return " ".join(w + "%%%" for w in clean().split())

    rows = [(i, clean(), "en", f"s{i % 20}") for i in range(80)] + [(80, clean(), None, None), (81, clean(), "de", "s1")]
    bad = [(100, junk(), "en", "s1"), (101, junk(), "en", "own"), (102, junk(), "de", "s1"), (103, junk(), None, None)]
    found = quality.judge(spark.createDataFrame(rows + bad, "doc_id long, text string, lang string, source string"))
    judged = {r.doc_id: r for r in found.collect()}
    assert all(r.square is not None for r in judged.values())
    assert {i for i, r in judged.items() if not r.kept} == {100, 101, 102, 103}
    few = spark.createDataFrame(rows[:4], "doc_id long, text string, lang string, source string")
    assert all(r.square is not None and r.kept for r in quality.judge(few).collect())


@pytest.mark.parametrize("apart", [1, 50, 200, 500])
def test_passages_that_the_earlier_document_holds_twice(apart):
    rng = np.random.default_rng(apart)

    def own(n):
        return rng.integers(1 << 40, 1 << 62, n, dtype=np.uint64)

    def cut(words):
        s = (substrings.texts.shingles(words, substrings.SHINGLE) >> np.uint64(32)).astype(np.uint32)
        return s.view(np.int32)

    passage = own(60)
    changed = passage.copy()
    changed[30] += 1
    for held in (passage, changed):  # exactly, and nearly
        b = np.concatenate([own(20), held, own(apart), held, own(30)])
        a = np.concatenate([own(25), passage, own(25)])
        assert substrings.passages(cut(a), cut(b)) == [(25, 81)]


def test_substrings_where_an_earlier_document_holds_a_part(spark):
    """An earlier document with 20 to 49 of a passage's 60 words, and near copies alone."""
    rng = random.Random(11)

    def own(n):
        return [f"w{rng.getrandbits(48)}" for _ in range(n)]

    rows, copies, near = [], [], []
    for k in range(160):
        passage = own(60)
        part = passage[: rng.choice([20, 30, 40, 49])]
        changed = list(passage)
        changed[30] = "changed"
        for w in (part, passage, passage) if k % 2 else (passage, changed):
            rows.append((len(rows), " ".join(own(30) + w + own(30))))
        (copies if k % 2 else near).append(len(rows) - 1)
    found = {r.doc_id: r.first_id for r in substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found.get(i) for i in copies] == [i - 1 for i in copies]
    assert [found.get(i) for i in near] == [i - 1 for i in near]


def test_id_store_has_the_added_tokens_of_the_file(spark):
    path = public.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = [
        None, "", end, f"a{end} b", f"a {end}{end}b", f" {end} \n{end}\n", "<|endoftext", "|>", f"<|end{end}oftext|>x",
        f"don't{end}s  é{end}é", "a b", f"word {end[:6]} {end[6:]}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = {r.doc_id: (r.n_tokens, bytes(r.data)) for r in id_store.write_and_read(docs, path).collect()}
    ids = [own.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    assert found == {i: (len(x), np.array(x, "<u4").tobytes()) for i, x in enumerate(ids)}
    assert 50256 in ids[3]
