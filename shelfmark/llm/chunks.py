"""Encoding of whole texts by way of their distinct chunks.

A byte-level tokenizer first splits a text by a pattern, then encodes each match by
itself. ``bounds`` finds places where the pattern is certain to split whatever surrounds
them, so chunks between such places encode the same alone as in their text, and each
distinct chunk needs encoding once for a slice of texts, or once for a worker while it is
in the memo. Chunks are told apart by two independent 64-bit hashes.
"""

import numpy as np
import pyarrow as pa

from shelfmark.llm import texts

#: Chunks that a worker remembers, about 40 bytes each; then it starts anew.
MEMO = 500_000

_LETTER = texts.byte_set((0x41, 0x5A), (0x61, 0x7A))
_PUNCT = texts.byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_SHOWN = texts.byte_set((0x21, 0x7E))
#: First bytes of characters that are surely no white space: U+00C0 to U+07FF, U+4000 to
#: U+DFFF, and those beyond U+FFFF.
_LEAD = texts.byte_set((0xC3, 0xDF), (0xE4, 0xED), (0xF0, 0xF4))
_LEAD2, _LEAD3, _LEAD4 = (
    texts.byte_set((0xC3, 0xDF)), texts.byte_set((0xE4, 0xED)), texts.byte_set((0xF0, 0xF4))
)


def bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at a single space between characters that are surely not white
    space, before and after such a line feed, between a letter and punctuation (ASCII), and
    at the beginning of each text."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        ends = _SHOWN[data]  # the character that ends at this byte is not white space
        later = (data & 0xC0) == 0x80
        ends[1:] |= later[1:] & _LEAD2[data[:-1]]
        ends[2:] |= later[2:] & later[1:-1] & _LEAD3[data[:-2]]
        ends[3:] |= later[3:] & later[2:-1] & later[1:-2] & _LEAD4[data[:-3]]
        begins = _SHOWN[data] | _LEAD[data]
        between = ends[:-2] & begins[2:]
        cut[1 : n - 1] |= between & (data[1:-1] == 0x20)
        line = between & (data[1:-1] == 0x0A)
        cut[1 : n - 1] |= line
        cut[2:n] |= line
        cut[1:n] |= _LETTER[data[:-1]] & _PUNCT[data[1:]]
    cut[np.unique(offsets)] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """``encode`` gives the ids of a list of chunks; ``cuts`` says where chunks begin."""

    def __init__(self, encode, cuts=bounds):
        self.encode, self.cuts = encode, cuts
        self.forget()

    def forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def __call__(self, column: pa.Array):
        """The ids of all rows, one after the other, and each row's range of them."""
        data, offsets = texts.raw(column)
        starts = self.cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        rows = np.searchsorted(starts, offsets)
        keys = texts.hashes(data, starts, ends)
        checks = texts.hashes(data, starts, ends, second=True)
        order = np.argsort(keys)
        ranked = keys[order]
        fresh = np.ones(len(keys), bool)
        np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
        group = np.empty(len(keys), np.int64)
        group[order] = np.cumsum(fresh) - 1
        heads = order[fresh]
        sure = bool((checks == checks[heads][group]).all())
        if not sure:  # two chunks with one key: each chunk by itself, nothing remembered
            group = heads = np.arange(len(keys))
        known, at = np.zeros(len(heads), bool), np.zeros(len(heads), np.int64)
        if sure and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys[heads]), len(self.keys) - 1)
            known = (self.keys[at] == keys[heads]) & (self.checks[at] == checks[heads])
        new = heads[~known]
        chunks = [data[a:b].tobytes().decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())]
        got = self.encode(chunks) if chunks else []
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((i for g in got for i in g), np.uint32, int(sizes.sum()))
        begin, size = np.empty(len(heads), np.int64), np.empty(len(heads), np.int64)
        begin[known], size[known] = self.begins[at[known]], self.sizes[at[known]]
        begin[~known], size[~known] = len(self.pool) + np.cumsum(sizes) - sizes, sizes
        pool = np.concatenate([self.pool, flat])
        lengths = size[group]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = pool[np.repeat(begin[group] - total[:-1], lengths) + np.arange(total[-1])]
        if sure:
            self._remember(keys[new], checks[new], begin[~known], sizes, pool)
        return ids, total[rows]

    def _remember(self, keys, checks, begins, sizes, pool):
        """``keys`` are sorted."""
        if len(self.keys) + len(keys) > MEMO:
            self.forget()
            return
        at = np.searchsorted(self.keys, keys)
        if len(self.keys):
            other = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
            at, keys, checks, begins, sizes = (x[other] for x in (at, keys, checks, begins, sizes))
        self.keys = np.insert(self.keys, at, keys)
        self.checks = np.insert(self.checks, at, checks)
        self.begins = np.insert(self.begins, at, begins)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.pool = pool
