"""Whole text columns as numpy arrays: words, 64-bit word hashes, shingles.

A null text counts as empty. Hashes are fixed functions of the bytes, the same in every
process. Temporary memory is bounded by ``SLICE`` bytes of text, or one row if longer,
and by ``BLOCK`` bytes while hashing.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 4 << 20
BLOCK = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE2 = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 1 << 62)) * 4 + 3
_PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def slices(column: pa.Array, limit: int = SLICE):
    """(first, last + 1) of runs of rows with at most ``limit`` bytes together, or one row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    first = held = 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > limit:
            yield first, i
            first, held = i, 0
        held += size
    if len(sizes) > first:
        yield first, len(sizes)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, one after the other, and where each row begins and ends."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """Begin and end of every word, and each row's range of words."""
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    ends[tails] = inside[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def _powers(n: int):
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashes(data, starts, ends, second: bool = False) -> np.ndarray:
    """64-bit hashes of data[start:end], which follow each other. ``second``: independent ones."""
    table, out = _BYTE2 if second else _BYTE, np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low, high = starts[i], ends[j - 1]
        powers, inverse = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[data[low:high]] * powers[: high - low], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * inverse[starts[i:j] - low]
        i = j
    return mix(out)


def placed_words(column: pa.Array, separators: np.ndarray):
    """Hashes of the lower-cased (A-Z) words of all rows, each row's range of words, and
    where words begin and end in their row's bytes."""
    data, offsets = raw(column)
    data = LOWER[data]
    starts, ends, rows = spans(data, offsets, separators)
    base = np.repeat(offsets[:-1], np.diff(rows))
    return hashes(data, starts, ends), rows, starts - base, ends - base


def word_hashes(column: pa.Array, separators: np.ndarray):
    return placed_words(column, separators)[:2]


def without(column: pa.Array, cuts: list[list[tuple[int, int]]]) -> pa.Array:
    """The texts without the given byte ranges of each row, which are sorted and disjoint."""
    out = column.to_pylist()
    for i, ranges in enumerate(cuts):
        if ranges:
            whole, rest, at = out[i].encode(), [], 0
            for low, high in ranges:
                rest.append(whole[at:low])
                at = high
            out[i] = b"".join([*rest, whole[at:]]).decode()
    return pa.array(out, pa.string())


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; with fewer words, of the whole run."""
    size = min(size, len(words))
    if not size:
        return words[:0]
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out += words[j : n + j] * _PLACE[j]
    return mix(out)


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]
