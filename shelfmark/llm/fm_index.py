"""Benchmark decontamination with FM-indexes over shards of documents.

A shard is a run of documents in one task, about ``SHARD_WORDS`` words. Words that occur
in no benchmark item become breaks, and stretches between breaks that are shorter than the
shortest test phrase are left out, since no phrase can lie in them. Over what remains:
suffix array, Burrows-Wheeler transform, a wavelet matrix for ranks, and every
``SAMPLE``-th text position kept. All phrases search backward together, one symbol a
round; found rows walk back to sampled positions, and the spans are merged per document.
A shard's index lives as long as its task, so a lost executor only repeats tasks.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.tables import staged

WINDOW = 10
SHARD_WORDS = 1 << 20
SAMPLE = 8
#: Bytes of benchmark text in one broadcast block of phrases.
BLOCK_BYTES = 8 << 20
#: Words of a longer item are cut into parts of so many, which overlap by a window.
PART_WORDS = 100_000


class WaveletMatrix:
    """Ranks of a sequence of symbols below 2 ** levels."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels, self.ones, self.zeros = max(1, int(top).bit_length()), [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its end."""
        low, high = np.zeros_like(ends), ends.copy()
        for k, level in enumerate(reversed(range(self.levels))):
            ones, bit = self.ones[k], ((symbols >> level) & 1).astype(bool)
            a, b = ones[low], ones[high]
            low = np.where(bit, self.zeros[k] + a, low - a)
            high = np.where(bit, self.zeros[k] + b, high - b)
        return high - low

    def at(self, rows: np.ndarray) -> np.ndarray:
        out, rows = np.zeros(len(rows), np.int64), rows.copy()
        for k in range(self.levels):
            ones = self.ones[k]
            bit = ones[rows + 1] - ones[rows]
            out = out * 2 + bit
            rows = np.where(bit == 1, self.zeros[k] + ones[rows], rows - ones[rows])
        return out


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling; later rounds sort what still ties only."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = _ranks(symbols[order], order, np.zeros(n, np.int64))
    width = 1
    while width < n:
        sorted_rank = rank[order]
        tied = np.zeros(n, bool)
        same = sorted_rank[1:] == sorted_rank[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        places = np.flatnonzero(tied)
        if not len(places):
            break
        rows = order[places]
        after = np.where(rows + width < n, rank[np.minimum(rows + width, n - 1)] + 1, 0)
        key = rank[rows] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        rows, key = rows[by], key[by]
        order[places] = rows
        # within a group of ties the rank is the place of the first equal key
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        new = places[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        rank = rank.copy()
        rank[rows] = new
        width *= 2
    return order


def _ranks(values, order, out):
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    out[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    return out


class FMIndex:
    """Finds phrases in a text of symbols 1.. (0 ends it and occurs nowhere else)."""

    def __init__(self, symbols: np.ndarray, top: int):
        text = np.append(symbols.astype(np.int64), 0)
        order = suffix_array(text)
        self.n = len(text)
        self.before = np.zeros(top + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=top + 1), out=self.before[1:])
        self.ranks = WaveletMatrix(text[order - 1], top)
        self.sampled = order % SAMPLE == 0
        self.sample = np.where(self.sampled, order, 0)[self.sampled]
        self.sample_rank = np.cumsum(self.sampled) - 1

    def search(self, phrases: np.ndarray, lengths: np.ndarray):
        """(first, last + 1) row of each phrase; phrases are right-aligned in the matrix."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        live = np.arange(len(phrases))
        for k in range(width):
            live = live[(lengths[live] > k) & (low[live] < high[live])]
            if not len(live):
                break
            symbols = phrases[live, width - 1 - k]
            low[live] = self.before[symbols] + self.ranks.rank(symbols, low[live])
            high[live] = self.before[symbols] + self.ranks.rank(symbols, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to a sampled one."""
        out, rows = np.zeros(len(rows), np.int64), rows.copy()
        live, steps = np.arange(len(rows)), 0
        while len(live):
            hit = self.sampled[rows[live]]
            done = live[hit]
            out[done] = self.sample[self.sample_rank[rows[done]]] + steps
            live = live[~hit]
            symbols = self.ranks.at(rows[live])
            rows[live] = self.before[symbols] + self.ranks.rank(symbols, rows[live])
            steps += 1
        return out


class Phrases:
    """The distinct windows of a block of items, as symbols of the block's own words."""

    def __init__(self, items: list[tuple[str, str, bool]]):
        self.items = [i for i, _, _ in items]
        words, rows = texts.word_hashes(pa.array([t for _, t, _ in items], pa.string()), texts.NOT_ALNUM)
        self.words = texts.distinct(words)
        symbols = np.searchsorted(self.words, words) + 1
        found: dict[tuple, set[int]] = {}
        for k, (low, high) in enumerate(zip(rows[:-1], rows[1:])):
            own = symbols[low:high].tolist()
            if own and (len(own) >= WINDOW or items[k][2]):
                for i in range(max(1, len(own) - WINDOW + 1)):
                    found.setdefault(tuple(own[i : i + WINDOW]), set()).add(k)
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.matrix = np.zeros((len(found), WINDOW), np.int64)
        for row, p in enumerate(found):
            self.matrix[row, WINDOW - len(p) :] = p
        self.owners = [sorted(x) for x in found.values()]
        self.least = int(self.lengths.min(initial=WINDOW))

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """1.. for the block's words, 0 for others."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1, 0)


def _hits(words: np.ndarray, rows: np.ndarray, phrases: Phrases):
    """(first word, last + 1, phrase) of every occurrence in documents of one shard."""
    symbols = phrases.symbols(words)
    # a break between documents, so that stretches end there
    symbols = np.insert(symbols, rows[1:-1], 0)
    place = np.insert(np.arange(len(words)), rows[1:-1], -1)
    known = np.concatenate([[False], symbols > 0, [False]])
    begins = np.flatnonzero(known[1:] & ~known[:-1])
    ends = np.flatnonzero(known[:-1] & ~known[1:])
    long = ends - begins >= phrases.least
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return (np.zeros(0, np.int64),) * 3
    keep = np.zeros(len(symbols) + 2, np.int64)
    keep[begins] += 1
    keep[ends + 1] -= 1  # with the break that follows
    kept = np.flatnonzero(np.cumsum(keep)[: len(symbols)])
    shown = symbols[kept]
    breaks = len(phrases.words) + 1
    index = FMIndex(np.where(shown == 0, breaks, shown), breaks)
    low, high = index.search(phrases.matrix, phrases.lengths)
    counts = high - low
    which = np.repeat(np.arange(len(counts)), counts)
    found = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = place[kept[index.locate(found)]]
    return first, first + phrases.lengths[which], which


def merged(spans):
    """Union of spans, sorted."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _scan(batches, block, cut):
    """Rows: id, text and, after an earlier block, its spans and items."""
    phrases = Phrases(block.value)
    for batch in batches:
        for low, high in texts.slices(batch.column(1), SHARD_WORDS * 8):
            part = batch.slice(low, high - low)
            column = part.column(1)
            words, rows, starts, ends = texts.placed_words(column, texts.NOT_ALNUM)
            first, last, which = _hits(words, rows, phrases)
            doc = np.searchsorted(rows, first, "right") - 1
            spans: list[list] = [[] for _ in range(high - low)]
            items: list[set] = [set() for _ in range(high - low)]
            if part.num_columns > 2:
                for d, (s, i) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    spans[d] = [(x["begin"], x["end"]) for x in s]
                    items[d] = set(i)
            for d, a, b, w in zip(doc.tolist(), first.tolist(), last.tolist(), which.tolist()):
                spans[d].append((a - int(rows[d]), b - int(rows[d])))
                items[d].update(phrases.items[k] for k in phrases.owners[w])
            joined = [merged(s) for s in spans]
            if cut:
                column = texts.without(
                    column,
                    [[(starts[rows[d] + a], ends[rows[d] + b - 1]) for a, b in s] for d, s in enumerate(joined)],
                )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), column,
                    pa.array([[{"begin": a, "end": b} for a, b in s] for s in joined], _SPANS),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                    pa.array(np.diff(rows), pa.int64()),
                ],
                names=["id", "text", "spans", "items", "n_words"],
            )


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_SCHEMA = "text string, spans array<struct<begin: long, end: long>>, items array<string>, n_words long"


def _blocks(benchmark: DataFrame, id: str, text: str):
    """Lists of (item, text, whole) of bounded size, one after the other."""
    word = "[0-9A-Za-z\\\\x{80}-\\\\x{10FFFF}]+"
    parts = benchmark.where(F.col(text).isNotNull()).select(
        F.col(id).cast("string").alias("item"), F.expr(f"regexp_extract_all(`{text}`, '{word}', 0)").alias("w")
    ).where("size(w) > 0").selectExpr(
        "item", "w", f"explode(sequence(0, greatest(size(w) - {WINDOW}, 0), {PART_WORDS})) AS at"
    ).selectExpr(
        "item", f"array_join(slice(w, at + 1, {PART_WORDS + WINDOW - 1}), ' ') AS part",
        f"size(w) < {WINDOW} AS whole",
    )
    total = parts.agg(F.sum(F.octet_length("part"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES)
    for k in range(count):
        yield [tuple(r) for r in parts.where(F.expr(f"pmod(xxhash64(part), {count}) = {k}")).collect()]


def occurrences(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", cut: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, text, spans, items, n_words.

    Words are runs of letters, digits and characters beyond ASCII, in lower case (A-Z). A
    test phrase is ten consecutive words of an item, or all words of a shorter one. spans
    are the merged word ranges [begin, end) inside any occurrence; items the item ids, as
    sorted text, with an occurrence. With ``cut``, text comes without the spans, from the
    first byte of a span's first word to the last of its last. A null text has no words and
    stays null, an item without words has no phrases, equal items all count, an empty
    benchmark finds nothing. Rows of ``docs`` with the same id keep their own results. A
    benchmark larger than ``BLOCK_BYTES`` is searched in blocks, one pass for each.
    """
    found = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {found.schema['id'].dataType.simpleString()}, {_SCHEMA}"
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item, item_text)
    block = next(blocks, [])
    while block is not None:
        following = next(blocks, None)
        scan = partial(_scan, block=context.broadcast(block), cut=cut and following is None)
        found = found.mapInArrow(scan, schema)
        if following is not None:
            found = staged(found, "occurrences").drop("n_words")
        block = following
    return found.withColumnsRenamed({"id": id, "text": text})
