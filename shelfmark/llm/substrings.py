"""Near-duplicate passages by compact windows.

The tokens of a document are its five-word shingles. For each of ``FUNCTIONS`` hash
functions, a Cartesian tree over the hashed tokens gives windows (l, c, r): any run that
begins in l..c and ends in c..r has its minimum at c, so one window stands for all of
these runs and they share its signature value. Windows at least as wide as the shortest
passage are posted under their value, once: values meet in one shuffle, sorted by document,
and a pass over them lets every window meet the value's first window and that of the
nearest earlier document under it, so groups are never listed in pairs or held in memory.
Of a value that many documents of one slice of texts share, only the ``POSTED`` first are
posted; the others meet the slice's own first and nearest holder right there, so values
of boilerplate are few rows wherever they meet. Windows of the first function whose value has
further holders, which they so do not meet, go another way as well: their runs of WIDTH shingles
are hashed whole, and each run meets its first holder. Of those that meet all holders, two that are
alike next to the deciding shingle need no second function. So no run of WORDS words that an earlier
document holds is lost, however many documents share its values. Where windows of ``ENOUGH`` functions meet
the same earlier document over one stretch (interval join), the stretch is a candidate, and
its shingles are compared with the earlier document's.

Rows are told apart by id and text, and ordered by id, then by a hash of the text.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.tables import small, staged

SHINGLE = 5
#: The shortest passage, in words.
WORDS = 50
FUNCTIONS = 5
ALIKE = 5
ENOUGH = 2
#: Documents of a slice of texts that post a value; others meet it within the slice.
POSTED = 4
#: Stretches of earlier documents are widened to multiples of this, so that many that meet
#: one document ask for the same few.
GRAIN = 64
SIMILARITY = 80  # percent
WIDTH = WORDS - SHINGLE + 1
#: The lesser part of a run of WIDTH shingles that lies on one side of its least one.
HALF = WIDTH // 2
#: Bytes of texts that are cut into words at once.
READ = 1 << 20
#: Words of texts whose windows are found at once.
TOGETHER = 1 << 16
#: Windows under one value that a task compares, or else sends on all.
COMPARED = 20_000
#: Runs that a task holds before it hands them on.
HELD = 1_000_000
_FACTORS = np.random.Generator(np.random.PCG64(4)).integers(
    1, 1 << 63, FUNCTIONS, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` of all runs of ``width`` values."""
    done = 1
    while 2 * done <= width:
        values, done = pick(values[done:], values[:-done]), 2 * done
    return pick(values[: len(values) - width + done], values[width - done :]) if width > done else values


def _next(values: np.ndarray, owner: np.ndarray, ties: bool) -> np.ndarray:
    """The nearest place before each that holds less (with ``ties``, or as much) in the same
    text, else -1. All values between are no less, so a place may go on from where another is."""
    out = np.arange(len(values)) - 1
    open_ = np.arange(len(values))
    while len(open_):
        at = out[open_]
        same = (at >= 0) & (owner[at] == owner[open_])
        out[open_[~same]] = -1
        open_, at = open_[same], at[same]
        more = values[at] > values[open_] if ties else values[at] >= values[open_]
        open_, at = open_[more], at[more]
        out[open_] = out[at]
    return out


def wide_windows(values: np.ndarray, ends: np.ndarray, width: int = WIDTH):
    """Of texts that lie one after the other and end at ``ends``: text, l, c, r (inclusive) of every node of
    their Cartesian trees at least ``width`` wide, by text and c.

    Such a node is the least value of a run of ``width``, and so are the nodes that bound it."""
    if len(values) < width:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    least = _sliding(values, width, np.minimum)
    begins = np.append(0, ends[:-1])
    text = np.repeat(np.arange(len(ends)), ends - begins)
    least[text[: len(least)] != text[width - 1 :]] = 0  # runs across texts are none
    none = np.zeros(width - 1, values.dtype)
    c = np.flatnonzero(_sliding(np.concatenate([none, least, none]), width, np.maximum) == values)
    v, text = values[c], text[c]
    left, right = _next(v, text, True), len(c) - 1 - _next(v[::-1], text[::-1], False)[::-1]
    l = np.where(left >= 0, c[left] + 1, begins[text])
    r = np.where(right < len(c), c[np.minimum(right, len(c) - 1)] - 1, ends[text] - 1)
    wide = r - l + 1 >= width
    return text[wide], l[wide], c[wide], r[wide]


def compact_windows(values: np.ndarray, width: int = WIDTH) -> list[tuple[int, int, int]]:
    """(l, c, r), inclusive, of every node of the Cartesian tree at least ``width`` wide."""
    _, *found = wide_windows(values, np.array([len(values)]), width)
    return list(zip(*(x.tolist() for x in found)))


def _windows_by_stack(values: list[int], width: int) -> list[tuple[int, int, int]]:
    """The same value by value."""
    n = len(values)
    left, right, stack = [0] * n, [n - 1] * n, []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = i - 1
        left[i] = stack[-1] + 1 if stack else 0
        stack.append(i)
    return [(left[c], c, right[c]) for c in range(n) if right[c] - left[c] + 1 >= width]


_PLACES = ["l", "r", "hl", "hr"]


def _order(rows: pa.StructArray) -> np.ndarray:
    """Each row's place in the order of (id, text hash), nulls first; equal rows share one."""
    id, hashed = rows.field(0), rows.field(1)
    ids = pa.table({"id": id, "hash": hashed})
    at = pc.sort_indices(ids, [("id", "ascending"), ("hash", "ascending")], null_placement="at_start").to_numpy()
    codes = id.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)[at]
    hashes = hashed.to_numpy(zero_copy_only=False)[at]
    new = np.ones(len(at), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (hashes[1:] != hashes[:-1])
    out = np.empty(len(at), np.int64)
    out[at] = np.cumsum(new) - 1
    return out


def _met(keys: np.ndarray, docs: np.ndarray):
    """For windows sorted by key and document: each one's number of earlier documents under
    its key, the key's first window, and the first window of the document before its own."""
    n = len(keys)
    new_key = np.ones(n, bool)
    new_key[1:] = keys[1:] != keys[:-1]
    new_doc = new_key.copy()
    new_doc[1:] |= docs[1:] != docs[:-1]
    first = np.maximum.accumulate(np.where(new_key, np.arange(n), 0))
    runs = np.flatnonzero(new_doc)
    run = np.cumsum(new_doc) - 1
    return run - run[first], first, runs[np.maximum(run - 1, 0)]


def _pairs(earlier, first, near, wanted):
    """(later, earlier) windows: with the first one, and with the nearest if that is another."""
    a, b = np.flatnonzero(wanted & (earlier > 0)), np.flatnonzero(wanted & (earlier > 1))
    return np.concatenate([a, b]), np.concatenate([first[a], near[b]])


def _halves(sums, l, c, r) -> np.ndarray:
    """16 bits each of the HALF shingles that end and begin with the least one. Any run of WIDTH
    about it holds one of the two; 0 for one that the window has no room for."""
    left, right = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
    for half, first, there in ((left, c - HALF + 1, c - l >= HALF - 1), (right, c, r - c >= HALF - 1)):
        at = first[there]
        half[there] = np.maximum(texts.mix(sums[at + HALF] - sums[at]) >> np.uint64(48), np.uint64(1)).astype(np.int64)
    return (left << 16 | right).astype(np.uint32).view(np.int32)


def _shared(key: np.ndarray, docs: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """Windows that have one of their halves in common with another document's under their key."""
    halves, out = halves.view(np.uint32), np.zeros(len(key), bool)
    for half in (halves >> 16, halves & 0xFFFF) if len(key) else ():
        at = np.lexsort((docs, half, key))
        k, h, d = key[at], half[at], docs[at]
        first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1])))
        # sorted by document: of several if the last is not the first
        several = (d[np.append(first[1:], len(d)) - 1] != d[first]) & (h[first] > 0)
        out[at] |= np.repeat(several, np.diff(np.append(first, len(d))))
    return out


def _parts(docs: np.ndarray, sizes: np.ndarray):
    """``docs`` in order, in parts of at most TOGETHER words, or of one document."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(docs):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + TOGETHER, "right")))
        yield docs[first:last]
        first = last


def _windows_of(words, rows, docs):
    """By function: the document, key, l, r, c and halves of all windows of some texts."""
    sizes = rows[docs + 1] - rows[docs]
    ends = np.cumsum(sizes)
    held = words[np.repeat(rows[docs] - ends + sizes, sizes) + np.arange(ends[-1])]
    # shingles of all texts, one after the other, without those across texts
    sizes = sizes - SHINGLE + 1
    begins = ends - sizes - SHINGLE + 1
    ends = np.cumsum(sizes)
    s = texts.shingles(held, SHINGLE)[np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1])]
    begins = ends - sizes
    sums = np.append(np.uint64(0), np.cumsum(texts.mix(s), dtype=np.uint64))
    for f in range(FUNCTIONS):
        hashed = s * _FACTORS[f]
        text, l, c, r = wide_windows(hashed, ends)
        # the function in the lowest bits
        keys = texts.mix(hashed[c]) & ~np.uint64(7) | np.uint64(f)
        none, base = np.zeros(len(c), np.int32), begins[text]
        halves = none if f else _halves(sums, l, c, r)
        l, r, c = ((x - base).astype(np.int32) for x in (l, r, c))
        yield docs[text].astype(np.int32), keys, l, r, none if f else c, halves


def _posted(batches):
    """Rows: row, text. Gives windows to post (of function 0 with ``c`` and their halves as ``hl``), and pairs met in a slice (with ``other``), which
    a number of their own spreads over the shuffle."""
    for batch in batches:
        rank = _order(batch.column(0)) if batch.num_rows else None
        for low, high in texts.slices(batch.column(1)):
            if (out := _posted_of(batch, rank, low, high)) is not None:
                yield out
                del out


def _posted_of(batch: pa.RecordBatch, rank, low: int, high: int) -> pa.RecordBatch | None:
    words = [x for _, x in _words_of(batch.column(1).slice(low, high - low))]
    rows = np.append(0, np.cumsum([len(x) for x in words]))
    words = np.concatenate(words)
    docs = np.flatnonzero(np.diff(rows) >= WORDS)
    if not len(docs):
        return None
    docs = docs[np.argsort(rank[low + docs], kind="stable")]
    found = [x for part in _parts(docs, np.diff(rows)[docs]) for x in _windows_of(words, rows, part)]
    owner, keys, l, r, least, halves = (np.concatenate(x) for x in zip(*found))
    del found, words
    # those of one key are of one function, so by document and place already
    at = np.argsort(keys, kind="stable")
    owner, keys, least, halves = low + owner[at], keys[at].view(np.int64), least[at], halves[at]
    windows = np.stack([l[at], r[at]], axis=1)
    del l, r, at
    earlier, first, near = _met(keys, rank[owner])
    later, other = _pairs(earlier, first, near, earlier >= POSTED)
    post = np.flatnonzero(earlier < POSTED)
    rows = batch.column(0).take(pa.array(np.concatenate([owner[post], owner[later]])))
    none = np.zeros(len(post), np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([keys[post], texts.mix(later.view(np.uint64)).view(np.int64)])),
            pa.array(np.concatenate([keys[post], keys[later]])), rows,
            pa.array(np.concatenate([windows[post, 0], windows[later, 0]])),
            pa.array(np.concatenate([windows[post, 1], windows[later, 1]])),
            pa.array(np.concatenate([least[post], least[later]])),
            batch.column(0).take(pa.array(
                np.concatenate([none, owner[other]]),
                mask=np.arange(len(post) + len(later)) < len(post),
            )),
            pa.array(np.concatenate([halves[post], windows[other, 0]])),
            pa.array(np.concatenate([none, windows[other, 1]])),
        ],
        names=["spread", "key", "row", "l", "r", "c", "other", "hl", "hr"],
    )


def _met_in_order(batches):
    """Rows of ``_posted``, sorted by key, document and place. Gives pairs of windows. Of a key
    that goes on in the next batch its first window and those of its last two documents stay."""
    kept = None
    for batch in batches:
        done = pc.is_valid(batch.column("other"))
        ready = batch.filter(done)
        if len(ready):
            yield _window_pairs(*[ready.column(c) for c in ("key", "row", "other", *_PLACES)])
        rows = pa.Table.from_batches([batch.filter(pc.invert(done))]).select(["key", "row", "l", "r", "hl"])
        if not len(rows):
            continue
        old = len(kept) if kept is not None else 0
        rows = (pa.concat_tables([kept, rows]) if old else rows).combine_chunks()
        key, row, l, r, halves = (c.chunk(0) for c in rows.columns)
        keys = key.to_numpy(zero_copy_only=False)
        earlier, first, near = _met(keys, _order(row))
        later, other = _pairs(earlier, first, near, np.arange(len(keys)) >= old)
        if len(later):
            # windows of function 0 that are alike in a half count once more, as function ALIKE
            a, b = (halves.to_numpy().view(np.uint32)[x] for x in (later, other))
            x = a ^ b
            alike = np.flatnonzero(((x >> 16 == 0) & (a >> 16 > 0)) | ((x & 0xFFFF == 0) & (a & 0xFFFF > 0)))
            later, other = (np.concatenate([x, x[alike]]) for x in (later, other))
            taken = np.concatenate([keys[later[: len(later) - len(alike)]], np.full(len(alike), ALIKE)])
            later, other = pa.array(later), pa.array(other)
            yield _window_pairs(
                pa.array(taken), row.take(later), row.take(other),
                l.take(later), r.take(later), l.take(other), r.take(other),
            )
        own = np.flatnonzero(earlier == earlier[-1])
        own = own[own >= first[-1]][0]  # the first window of the last document
        kept = rows.take(pa.array(np.unique([first[-1], near[-1] if earlier[-1] else first[-1], own])))


class _Unmet:
    """Of windows of function 0 in the order of ``_met_in_order``, those under values that hold more windows of
    earlier documents than a later one meets, if one of their halves is another document's too.
    Held back are fewer than COMPARED windows of one value; more are all given."""

    def __init__(self):
        self.held, self.hot, self.found = None, None, []

    def _add(self, rows: pa.Table):
        key, row, l, r, c = (x.combine_chunks() for x in rows.select(["key", "row", "l", "r", "c"]).columns)
        l, r, c = (x.to_numpy(zero_copy_only=False) for x in (l, r, c))
        # where runs of WIDTH shingles begin whose minimum is at c
        a, b = (pa.array(x.astype(np.int32)) for x in (np.maximum(l, c - WIDTH + 1), np.minimum(c, r - WIDTH + 1)))
        none, zero = pa.nulls(len(key), row.type), pa.array(np.zeros(len(key), np.int32))
        self.found.append(_window_pairs(key, row, none, a, b, zero, zero))

    def add(self, batch: pa.RecordBatch):
        rows = pa.Table.from_batches([batch.filter(pa.array(batch.column("key").to_numpy() & 7 == 0))])
        met = pc.is_valid(rows["other"])
        if pc.any(met).as_py():
            self._add(rows.filter(met))
        rows = rows.filter(pc.invert(met))
        if not len(rows):
            return
        if self.held is not None:
            rows = pa.concat_tables([self.held, rows])
        rows = rows.combine_chunks()
        keys, docs = rows["key"].to_numpy(), _order(rows["row"].chunk(0))
        fresh = np.append(True, keys[1:] != keys[:-1])
        first = np.flatnonzero(fresh)
        begun = int(first[-1]) if len(keys) - first[-1] < COMPARED and keys[-1] != self.hot else len(keys)
        new_doc = fresh | np.append(True, docs[1:] != docs[:-1])
        last = np.maximum.reduceat(np.where(new_doc, np.arange(len(keys)), 0), first)
        unmet = last - first > np.minimum(np.add.reduceat(new_doc.astype(np.int64), first) - 1, 2)
        sent = np.repeat(unmet, np.diff(np.append(first, len(keys))))
        sent[sent] &= _shared(keys[sent], docs[sent], rows["hl"].to_numpy()[sent])
        sent |= keys == self.hot
        if begun < len(keys):
            self.hot, self.held = None, rows.slice(begun)
            sent[begun:] = False
        else:
            self.hot, self.held = keys[-1], None
            sent |= keys == self.hot
        if sent.any():
            self._add(rows.filter(pa.array(sent)))

    def finish(self):
        held, self.held = self.held, None
        if held is not None:
            keys, docs = held["key"].to_numpy(), _order(held["row"].combine_chunks())
            sent = _shared(keys, docs, held["hl"].to_numpy())
            if sent.any():
                self._add(held.filter(pa.array(sent)))

    def taken(self):
        out, self.found = self.found, []
        return out


def _met_and_unmet(batches):
    """Rows of ``_posted`` as for ``_met_in_order``. Gives its pairs, and without ``other`` where
    runs begin (l to r) whose holders a later document may not meet in these."""
    unmet = _Unmet()

    def seen():
        for batch in batches:
            unmet.add(batch)
            yield batch

    for pairs in _met_in_order(seen()):
        yield from unmet.taken()
        yield pairs
    unmet.finish()
    yield from unmet.taken()


def _window_pairs(key, row, other, l, r, hl, hr) -> pa.RecordBatch:
    f = pa.array((key.to_numpy(zero_copy_only=False) & 7).astype(np.int8))
    return pa.RecordBatch.from_arrays(
        [row, other, f, l, r, hl, hr], names=["row", "other", "f", *_PLACES]
    )


def _stretches(pair, f, l, r, hl, hr) -> np.ndarray:
    """Windows of pairs of documents, together by pair. Gives (pair, low, high, low, high) of
    stretches that windows of ENOUGH functions cover, and of what the windows over a stretch
    meet in the other document."""
    n = len(pair)
    at = np.concatenate([l, r + 1]).astype(np.int64)
    ends = np.arange(2 * n) >= n
    order = np.lexsort((ends, at, np.concatenate([pair, pair])))
    step = np.where(ends, -1, 1)[order]
    function = np.concatenate([f, f])[order]
    # every pair's windows have ended before the next pair's begin
    held = sum((np.cumsum(step * (function == k)) > 0).astype(np.int8) for k in range(ALIKE + 1))
    on = np.concatenate([[False], held >= ENOUGH])
    begins, stops = np.flatnonzero(on[1:] & ~on[:-1]), np.flatnonzero(~on[1:] & on[:-1])
    if not len(begins):
        return np.zeros((0, 5), np.int64)
    place = np.empty(2 * n, np.int64)
    place[order] = np.arange(2 * n)
    # the stretches a window is open in follow each other
    first = np.searchsorted(stops, place[:n], "right")
    last = np.searchsorted(begins, place[n:], "left")
    count = np.maximum(last - first, 0)
    window = np.repeat(np.arange(n), count)
    stretch = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    low, high = np.full(len(begins), 1 << 30, np.int64), np.full(len(begins), -1, np.int64)
    np.minimum.at(low, stretch, hl[window])
    np.maximum.at(high, stretch, hr[window])
    places = at[order]
    out = np.stack([
        np.concatenate([pair, pair])[order][begins], places[begins], places[stops] - 1, low, high
    ], axis=1)
    return out[(out[:, 2] - out[:, 1] + 1 >= WIDTH) & (out[:, 4] - out[:, 3] + 1 >= WIDTH)]


def _joined(batches):
    """Rows: row, other, collisions. Without ``other``, gives the ranges that collisions cover."""
    names = ["row", "other", "low", "high", "other_low", "other_high"]
    for batch in batches:
        if not batch.num_rows:
            continue
        alone = pc.is_null(batch.column(1))
        if pc.any(alone).as_py():
            yield _ranges(batch.filter(alone), names)
            batch = batch.filter(pc.invert(alone))
            if not batch.num_rows:
                continue
        lists = batch.column(2)
        flat = lists.flatten()
        f, l, r, hl, hr = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
        pair = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        found = _stretches(pair, f, l, r, hl, hr)
        rows = pa.array(found[:, 0])
        first, last = found[:, 3] // GRAIN * GRAIN, found[:, 4] // GRAIN * GRAIN + GRAIN - 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows),
             *(pa.array(x.astype(np.int32)) for x in (found[:, 1], found[:, 2], first, last))],
            names=names,
        )


def _ranges(batch: pa.RecordBatch, names) -> pa.RecordBatch:
    lists = batch.column(2)
    l, r = (lists.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
    owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    at = np.lexsort((l, owner))
    # rows apart by more than a place
    base = owner[at] * (int(r.max()) + 3)
    l, r = l[at] + base, np.maximum.accumulate(r[at] + base)
    first = np.flatnonzero(np.append(True, l[1:] > r[:-1] + 1))
    last = np.append(first[1:], len(l)) - 1
    rows, lows, highs = pa.array(owner[at][first]), l[first] - base[first], r[last] - base[first]
    zero = pa.array(np.zeros(len(first), np.int32))
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(rows), batch.column(1).take(rows),
         *(pa.array(x.astype(np.int32)) for x in (lows, highs)), zero, zero],
        names=names,
    )


def _words_of(column: pa.Array):
    """Every text's place and words, a few texts at a time."""
    for low, high in texts.slices(column, READ):
        words, rows = texts.word_hashes(column.slice(low, high - low), texts.SPACES)
        for k, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
            yield low + k, words[a:b]


def _cut_out(batches):
    """Rows: row, text, stretches, begins. Gives the stretches' shingle hashes, in 32 bits; of the runs
    of WIDTH shingles that begin in a range of ``begins``, a hash in 96 bits: for the first document
    of the batch that holds a run, to be met by others, and for the others with its place there."""
    for batch in batches:
        if not batch.num_rows:
            continue
        # by document, so that the first one that holds a run comes first
        batch = batch.take(pa.array(np.argsort(_order(batch.column(0)), kind="stable")))
        rank, held_runs, held_shingles = _order(batch.column(0)), 0, 0
        owners, places, runs, checks, cuts, parts = [], [], [], [], [], []
        for k, words in _words_of(batch.column(1)):
            whole = texts.shingles(words, SHINGLE)
            s = (whole >> np.uint64(32)).astype(np.uint32).view(np.int32)
            begins = batch.column(3)[k].values
            if begins is not None and len(begins):
                marks = np.zeros(len(whole) + 1, np.int64)
                lows, highs = (begins.field(c).to_numpy(zero_copy_only=False) for c in ("low", "high"))
                np.add.at(marks, lows, 1)
                np.add.at(marks, highs + 1, -1)
                at = np.flatnonzero(np.cumsum(marks))
                owners.append(np.full(len(at), k))
                places.append(at)
                runs.append(_run_hashes(whole)[at])
                sums = np.append(np.uint64(0), np.cumsum(texts.mix(whole), dtype=np.uint64))
                checks.append(((sums[at + WIDTH] - sums[at]) >> np.uint64(32)).astype(np.uint32).view(np.int32))
                held_runs += len(at)
                if held_runs > HELD:
                    yield _runs_met(batch.column(0), rank, *map(np.concatenate, (owners, places, runs, checks)))
                    owners, places, runs, checks, held_runs = [], [], [], [], 0
            stretches = batch.column(2)[k].values
            if stretches is None:
                continue
            for low, high in zip(*(stretches.field(c).to_pylist() for c in ("low", "high"))):
                cuts.append((k, low, high))
                parts.append(s[low : high + 1])
                held_shingles += len(parts[-1])
                if held_shingles > HELD:
                    yield _stretches_cut(batch.column(0), cuts, parts)
                    cuts, parts, held_shingles = [], [], 0
        if parts:
            yield _stretches_cut(batch.column(0), cuts, parts)
        if owners:
            yield _runs_met(batch.column(0), rank, *map(np.concatenate, (owners, places, runs, checks)))


_CUT = ["row", "low", "high", "shingles", "run", "check", "other"]


def _stretches_cut(rows: pa.StructArray, cuts, parts) -> pa.RecordBatch:
    owner, low, high = np.array(cuts, np.int64).T
    sizes = np.append(0, np.cumsum([len(x) for x in parts])).astype(np.int32)
    n = len(parts)
    return pa.RecordBatch.from_arrays(
        [rows.take(pa.array(owner)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(parts))),
         pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, rows.type)],
        names=_CUT,
    )


def _runs_met(rows: pa.StructArray, rank, owner, place, run, check) -> pa.RecordBatch:
    # the runs come by document and place
    at = np.argsort(run, kind="stable")
    owner, place, run, check = (x[at] for x in (owner, place, run, check))
    fresh = np.append(True, (run[1:] != run[:-1]) | (check[1:] != check[:-1]))
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(run)), 0))
    later = np.flatnonzero(rank[owner] != rank[owner[first]])
    post = np.flatnonzero(fresh)
    at, n = np.concatenate([post, later]), len(post)
    posted = np.arange(len(at)) < n
    return pa.RecordBatch.from_arrays(
        [rows.take(pa.array(owner[at])), pa.array(place[at].astype(np.int32)),
         pa.array(np.where(posted, 0, place[first[at]]).astype(np.int32)),
         pa.nulls(len(at), pa.list_(pa.int32())), pa.array(run[at].view(np.int64), mask=~posted),
         pa.array(check[at]), rows.take(pa.array(owner[first[at]], mask=posted))],
        names=_CUT,
    )


def _run_stretches(batches):
    """Rows: row, other, places (low, high) of runs in both. Gives (row, other, begin, end) of the
    stretches that consecutive ones make."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(2)
        low, high = (lists.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        at = np.lexsort((low, owner))
        owner, low, high = owner[at], low[at], high[at]
        fresh = (owner[1:] != owner[:-1]) | (low[1:] - low[:-1] > 1) | (high[1:] - high[:-1] != low[1:] - low[:-1])
        first = np.flatnonzero(np.append(True, fresh))
        last = np.append(first[1:], len(low)) - 1
        rows = pa.array(owner[first])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows),
             pa.array(low[first]), pa.array(low[last] + WORDS)],
            names=["row", "other", "begin", "end"],
        )


def _run_hashes(x: np.ndarray) -> np.ndarray:
    """Hashes of all runs of WIDTH shingles."""
    powers, inverse = texts._powers(len(x) + 1)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(texts.mix(x.astype(np.uint64)) * powers[: len(x)], out=sums[1:])
    n = len(x) - WIDTH + 1
    return (sums[WIDTH:] - sums[:n]) * inverse[:n]


def _exact(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (begin, end) of ``a`` whose every run of WIDTH shingles ``b`` holds somewhere."""
    if min(len(a), len(b)) < WIDTH:
        return []
    own, held = _run_hashes(a), np.sort(_run_hashes(b))
    at = np.flatnonzero(held[np.minimum(np.searchsorted(held, own), len(held) - 1)] == own)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > 1)
    begins, ends = np.append(at[0], at[breaks + 1]), np.append(at[breaks], at[-1])
    return list(zip(begins.tolist(), (ends + WIDTH).tolist()))


def _runs(sums: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, length: int):
    """Runs of b, whose mixed shingles sum up to ``sums``, from each of ``firsts`` to the one
    of ``lasts`` that makes its length nearest to ``length``, nearest lengths first; runs of one
    content once."""
    at = np.searchsorted(lasts, firsts + length - 1)
    ends = np.stack([lasts[np.minimum(at, len(lasts) - 1)], lasts[np.maximum(at - 1, 0)]])
    off = np.where(ends >= firsts, np.abs(ends - firsts + 1 - length), len(sums) + length)
    ends = np.where(off[0] <= off[1], *ends)
    off = off.min(0)
    # of equal length and sum of mixed shingles: of one content
    held = sums[ends + 1] - sums[firsts]
    seen = set()
    for k in np.argsort(off, kind="stable").tolist():
        first, last = int(firsts[k]), int(ends[k])
        if last < first:
            continue
        content = last - first, int(held[k])
        if content not in seen:
            seen.add(content)
            yield first, last


def passages(a: np.ndarray, b: np.ndarray, similarity: int = SIMILARITY) -> list[tuple[int, int]]:
    """Stretches (begin, end) of ``a``, at least WIDTH long, that resemble one of ``b``.

    Exact ones are found by their runs of WIDTH shingles, wherever and however often b holds
    them. For near ones, a stretch shrinks to what both hold at its ends; if no run of b
    between places of those ends is similar enough, it is parted at its widest gap. None
    lies within another.
    """
    out, open_ = _exact(a, b), [(0, len(a))]
    order = np.argsort(b, kind="stable")
    ranked = b[order]
    common = ranked[np.minimum(np.searchsorted(ranked, a), len(b) - 1)] == a
    sums = np.append(np.uint64(0), np.cumsum(texts.mix(b.astype(np.uint64)), dtype=np.uint64))

    def places_of(x):
        return order[np.searchsorted(ranked, x) : np.searchsorted(ranked, x, "right")]

    while open_:
        low, high = open_.pop()
        hit = np.flatnonzero(common[low:high])
        if not len(hit):
            continue
        low, high = low + int(hit[0]), low + int(hit[-1]) + 1
        if high - low < WIDTH or any(x <= low and high <= y for x, y in out):
            continue
        own, places = texts.distinct(a[low:high]), np.flatnonzero(common[low:high])

        def similar(first, last):
            other = texts.distinct(b[first : last + 1])
            if 100 * min(len(own), len(other)) < similarity * max(len(own), len(other)):
                return False
            both = len(own) + len(other) - len(texts.distinct(np.concatenate([own, other])))
            return 100 * both >= similarity * (len(own) + len(other) - both)

        # no run of b is more similar than all that b holds is in common
        if 100 * len(texts.distinct(a[low:high][places])) >= similarity * len(own):
            firsts, lasts = places_of(a[low]), places_of(a[high - 1])
            # the whole run, and all of b where its ends come in another order, as well
            first, last = int(firsts[0]), int(lasts[-1])
            if last < first:
                first, last = 0, len(b) - 1
            if similar(first, last) or any(similar(*x) for x in _runs(sums, firsts, lasts, high - low)):
                out.append((low, high))
                continue
        gaps = np.diff(places)
        if not len(gaps):
            continue
        if gaps.max() > 1:
            at = int(gaps.argmax())
        else:  # all is held by b, in another order: part in the middle
            at = len(places) // 2 - 1
        open_.append((low, low + int(places[at]) + 1))
        open_.append((low + int(places[at + 1]), high))
    whole: list[tuple[int, int]] = []
    for low, high in sorted(out, key=lambda x: (x[0], -x[1])):
        if not whole or high > whole[-1][1]:
            whole.append((low, high))
    return whole


def _verified(batches):
    """Rows: row, other, low, a, b."""
    for batch in batches:
        owner, begins, ends = [], [], []
        (a_flat, a_ends), (b_flat, b_ends) = (
            (x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()) for x in batch.columns[3:5]
        )
        bases = batch.column(2).to_pylist()
        for k in range(batch.num_rows):
            a, b = a_flat[a_ends[k] : a_ends[k + 1]], b_flat[b_ends[k] : b_ends[k + 1]]
            if not len(b):
                continue
            base = bases[k]
            for low, high in passages(a, b):
                owner.append(k)
                begins.append(base + low)
                ends.append(base + high + SHINGLE - 1)
        rows = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows),
             pa.array(begins, pa.int64()), pa.array(ends, pa.int64())],
            names=["row", "other", "begin", "end"],
        )


def _spans(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(row, first, begin, end) of passages, where row and first are (id, hash of the text)."""
    source = docs.select(
        F.struct(F.col(id).alias("id"), F.xxhash64(text).alias("hash")).alias("row"), F.col(text).alias("text")
    )
    kind = source.schema["row"].dataType.simpleString()
    posted = source.mapInArrow(
        _posted, f"spread long, key long, row {kind}, l int, r int, c int, other {kind}, hl int, hr int"
    )
    pairs = posted.repartition("spread").drop("spread").sortWithinPartitions("key", "row", "l").mapInArrow(
        _met_and_unmet, f"row {kind}, other {kind}, f byte, l int, r int, hl int, hr int"
    )
    met = pairs.groupBy("row", "other").agg(
        F.collect_list(F.struct("f", *_PLACES)).alias("collisions"),  # of two documents, or one's windows
        F.bit_count(F.bit_or(F.expr("shiftleft(1, f)"))).alias("functions"),
    ).where(f"functions >= {ENOUGH} OR other IS NULL").select("row", "other", "collisions")
    stretches = staged(
        met.mapInArrow(
            _joined, f"row {kind}, other {kind}, low int, high int, other_low int, other_high int"
        ),
        "stretches",
    )
    found, unmet = stretches.where("other IS NOT NULL"), stretches.where("other IS NULL")
    place = F.struct("low", "high")
    wanted = found.select("row", place.alias("place"), F.lit(False).alias("alone")).union(
        found.selectExpr("other", "struct(other_low AS low, other_high AS high)", "false")
    ).distinct().union(unmet.select("row", place, F.lit(True)))
    # repeated rows are one document
    wanted = small(staged(wanted.groupBy("row").agg(
        F.collect_list(F.when(~F.col("alone"), F.col("place"))).alias("stretches"),
        F.collect_list(F.when(F.col("alone"), F.col("place"))).alias("begins"),
    ), "wanted"))
    cut = staged(source.join(wanted, "row").mapInArrow(
        _cut_out, f"row {kind}, low int, high int, shingles array<int>, run long, check int, other {kind}"
    ), "shingles")
    held = cut.where("shingles IS NOT NULL").select("row", "low", "high", "shingles").dropDuplicates(
        ["row", "low", "high"]
    )
    pairs = found.join(held.withColumnRenamed("shingles", "a"), ["row", "low", "high"]).join(
        held.selectExpr("row AS other", "low AS other_low", "high AS other_high", "shingles AS b"),
        ["other", "other_low", "other_high"],
    ).select("row", "other", "low", "a", "b")
    verified = pairs.mapInArrow(_verified, f"row {kind}, other {kind}, begin long, end long")
    # a run of unmet windows goes with its first holder, of a batch of texts or of all
    order = Window.partitionBy("run", "check").orderBy("row", "low")
    first = F.first(F.struct("row", "low")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = cut.where("run IS NOT NULL").withColumn("first", first).where("row <> first.row").selectExpr(
        "row", "first.row AS other", "low", "first.low AS high"
    ).union(cut.where("shingles IS NULL AND run IS NULL").select("row", "other", "low", "high"))
    exact = runs.groupBy("row", "other").agg(
        F.collect_list(place).alias("places")  # of two documents
    ).mapInArrow(_run_stretches, f"row {kind}, other {kind}, begin long, end long")
    # a passage that several earlier documents hold is listed once, with the first of them
    return verified.union(exact).groupBy("row", "begin", "end").agg(F.min("other").alias("first"))


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, first_id, begin, end): passages of at least WORDS words that an earlier document
    (by id, then by a hash of the text) holds too, or nearly: word ranges [begin, end) whose
    five-word shingles have a similarity of at least 0.8 with the earlier document's.

    Words are what white space leaves of the text in lower case (A-Z). first_id is the id of the
    first document under whose windows the passage was found, so that of a document which meets
    one of its windows' values first or just before it; a passage's first holder is not
    listed for it. Ranges of a document may overlap. Documents that are null, empty or short
    have none. Null ids are an id like others, before all; rows with one id and one text are one
    document, which is not compared with itself, and rows with one id and several texts are
    several. Further columns are not looked at.
    """
    return _spans(docs, id, text).select(
        F.col("row.id").alias(id), F.col("first.id").alias("first_id"), "begin", "end"
    )


def _without(batches):
    """Rows: text, spans. Words are counted again and the spans' bytes left out."""
    for batch in batches:
        for low, high in texts.slices(batch.column(0)):
            column = batch.column(0).slice(low, high - low)
            _, rows, starts, ends = texts.placed_words(column, texts.SPACES)
            cuts = []
            for k, spans in enumerate(batch.column(1).slice(low, high - low).to_pylist()):
                merged: list[list[int]] = []
                n = int(rows[k + 1] - rows[k])
                for x in sorted(spans or [], key=lambda x: (x["begin"], x["end"])):
                    a, b = x["begin"], min(x["end"], n)
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    elif a < b:
                        merged.append([a, b])
                cuts.append([(starts[rows[k] + a], ends[rows[k] + b - 1]) for a, b in merged])
            others = [batch.column(i).slice(low, high - low) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [texts.without(column, cuts), *others], names=["text", *batch.schema.names[2:]]
            )


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the passages of ``repeats`` taken out of their texts; all rows stay.

    What was found in a row is cut from rows of the same id and text, and from no others.
    """
    spans = _spans(docs, id, text).groupBy("row").agg(
        F.collect_list(F.struct("begin", "end")).alias("spans")  # of one document
    ).select(F.col("row").alias("span_of"), "spans")
    spans = small(staged(spans, "spans"))
    others = [c for c in docs.columns if c != text]
    # columns go by place: names of docs may be anything
    names = {c: f"c{i}" for i, c in enumerate(others)}
    row = F.struct(docs[id].alias("id"), F.xxhash64(docs[text]).alias("hash"))
    joined = docs.join(spans, row == spans["span_of"], "left").select(
        docs[text].alias("text"), "spans", *[docs[c].alias(n) for c, n in names.items()]
    )
    schema = ", ".join(["text string", *[f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in names.items()]])
    out = joined.mapInArrow(_without, schema)
    return out.select(*[
        F.col("text").alias(c) if c == text else F.col(names[c]).alias(c) for c in docs.columns
    ])
