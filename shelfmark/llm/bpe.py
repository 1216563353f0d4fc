"""Byte-level BPE on padded matrices.

Every match of the split pattern is a row of byte ids, padded to its length bucket. Each
round looks up the rank of every adjacent pair in a hash table, merges each row's leftmost
pair of least rank, closes the gap and drops rows that are done. Matches longer than
``LONG`` bytes merge in the same order with a heap, since rounds over a row cost its
length each. Decoding gathers the bytes of all ids at once.
"""

import base64
import hashlib
import heapq
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.chunks import Encoder

NONE = np.iinfo(np.int32).max
LONG = 1024
CELLS = 1 << 20
SLICE = 8 << 20
#: White space as the rank files' own library has it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class PairTable:
    """Ranks of pairs of ids: open addressing, probed for whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = np.fromiter(((a << 32) | b for a, b in pairs), np.int64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            _, first = np.unique(slots, return_index=True)
            takes = np.zeros(len(keys), bool)
            takes[first] = True
            takes &= free
            self.keys[slots[takes]], self.ranks[slots[takes]] = keys[takes], ranks[takes]
            keys, ranks = keys[~takes], ranks[~takes]
            slots = (slots[~takes] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys):
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, NONE where a pair has none. A negative id pairs with nothing."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        shape, keys = keys.shape, keys.ravel()
        out = np.full(len(keys), NONE, np.int32)
        live = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slots = self._slots(keys[live])
        while len(live):
            held = self.keys[slots]
            hit = held == keys[live]
            out[live[hit]] = self.ranks[slots[hit]]
            on = ~hit & (held != -1)
            live, slots = live[on], (slots[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


class Vocabulary:
    def __init__(self, rank_file: bytes, pattern: str):
        pairs = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ids = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        found = {}
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    found[left, right] = rank
        self.pairs, self.table = found, PairTable(found)
        own = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]")
        self.split = regex.compile(own.replace(r"\s", f"[{SPACE}]")).findall
        self.sizes = np.zeros(max(self.tokens) + 1, np.int64)
        for i, t in self.tokens.items():
            self.sizes[i] = len(t)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.flat = np.frombuffer(
            b"".join(self.tokens.get(i, b"") for i in range(len(self.sizes))), np.uint8
        )

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ids.get(piece)
            if whole is not None:
                out[k] = [whole]
            elif len(piece) > LONG:
                out[k] = self._merge_long(piece)
            else:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(k)
        for power, rows in buckets.items():
            width = 1 << power
            for i in range(0, len(rows), max(1, CELLS // width)):
                part = rows[i : i + max(1, CELLS // width)]
                for k, ids in zip(part, self._rounds([pieces[k] for k in part], width)):
                    out[k] = ids
        return out

    def _rounds(self, pieces: list[bytes], width: int) -> list[list[int]]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        padded = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        ids = self.bytes[padded.reshape(len(pieces), width)]
        ids[np.arange(width) >= lengths[:, None]] = -1
        ranks = self.table.get(ids[:, :-1], ids[:, 1:])
        rows, out = np.arange(len(pieces)), [None] * len(pieces)
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            for k, row in zip(rows[done].tolist(), ids[done].tolist()):
                out[k] = row[: row.index(-1)] if row[-1] == -1 else row
            rows, ids, ranks, at, best = (x[~done] for x in (rows, ids, ranks, at, best))
            if not len(rows):
                break
            n, here = ids.shape[1], np.arange(len(rows))
            step = np.arange(n - 1)
            ids[here, at] = best
            ids = np.take_along_axis(ids, step + (step > at[:, None]), 1)
            if n == 2:
                ranks = np.full((len(rows), 1), NONE, np.int32)
                ids = np.concatenate([ids, np.full((len(rows), 1), -1, ids.dtype)], 1)
                continue
            step = step[:-1]
            ranks = np.take_along_axis(ranks, step + (step >= at[:, None]), 1)
            left = at > 0
            ranks[here[left], at[left] - 1] = self.table.get(
                ids[here[left], at[left] - 1], ids[here[left], at[left]]
            )
            right = at < n - 2
            ranks[here[right], at[right]] = self.table.get(
                ids[here[right], at[right]], ids[here[right], at[right] + 1]
            )
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        get = self.pairs.get
        heap = [(r, i) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get((rank, ids[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := get((ids[h], rank))) is not None:
                heapq.heappush(heap, (r, h))
        return [i for i in ids if i >= 0]

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk, every match of the pattern by itself."""
        split = [self.split(c) for c in chunks]
        place: dict[str, int] = {}
        for pieces in split:
            for p in pieces:
                if p not in place:
                    place[p] = len(place)
        ids = self.merge([p.encode() for p in place])
        return [
            ids[place[p[0]]] if len(p) == 1 else [i for x in p for i in ids[place[x]]] for p in split
        ]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids. An id that the vocabulary lacks raises."""
        sizes = self.sizes[ids]
        if not sizes.all():
            raise ValueError("an id is not in the vocabulary")
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.begins[ids] - ends + sizes, sizes) + np.arange(total)]


_OPEN: dict = {}


def _opened(vocabulary):
    """One vocabulary and memo for each worker process."""
    file, pattern = vocabulary.value
    key = hashlib.sha256(file).digest(), pattern
    if key not in _OPEN:
        _OPEN.clear()
        own = Vocabulary(file, pattern)
        _OPEN[key] = own, Encoder(own.encode)
    return _OPEN[key]


def _encode(batches, vocabulary):
    own, encoder = _opened(vocabulary)
    for batch in batches:
        for low, high in texts.slices(batch.column(1), SLICE):
            ids, rows = encoder(batch.column(1).slice(low, high - low))
            lists = pa.ListArray.from_arrays(
                pa.array(rows.astype(np.int32)), pa.array(ids.astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), lists], names=["id", "ids"]
            )


def _decode(batches, vocabulary):
    own, _ = _opened(vocabulary)
    for batch in batches:
        out = [own.decode(np.array(x.values, np.int64)).tobytes() if x.is_valid else None
               for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, pa.binary())], names=["id", "bytes"]
        )


def _encode_and_check(batches, vocabulary):
    own, encoder = _opened(vocabulary)
    for batch in batches:
        for low, high in texts.slices(batch.column(1), SLICE // 8):
            ids, rows = encoder(batch.column(1).slice(low, high - low))
            ids = ids.astype(np.int32)
            decoded = [
                hashlib.sha256(own.decode(ids[a:b])).hexdigest()
                for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(ids)),
                    pa.array(decoded, pa.string()),
                ],
                names=["id", "ids", "decoded_sha256"],
            )


def _round_trip(batches, vocabulary):
    own, encoder = _opened(vocabulary)
    shown = [str(i) for i in range(len(own.sizes))]
    for batch in batches:
        for low, high in texts.slices(batch.column(1), SLICE):
            ids, rows = encoder(batch.column(1).slice(low, high - low))
            coded, decoded = [], []
            for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
                text = " ".join(map(shown.__getitem__, ids[a:b].tolist()))
                coded.append(hashlib.sha256(text.encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids[a:b])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low), pa.array(np.diff(rows), pa.int64()),
                    pa.array(coded, pa.string()), pa.array(decoded, pa.string()),
                ],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def _mapped(df, function, id, value, vocabulary_path, pattern, schema):
    """The rank file is read here, a few hundred kilobytes, and broadcast."""
    with open(vocabulary_path, "rb") as f:
        vocabulary = df.sparkSession.sparkContext.broadcast((f.read(), pattern))
    kind = df.schema[id].dataType.simpleString()
    found = df.select(F.col(id).alias("id"), F.col(value).alias("value")).mapInArrow(
        partial(function, vocabulary=vocabulary), f"id {kind}, {schema}"
    )
    return found.withColumnRenamed("id", id)


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, id="doc_id", text="text"):
    """(id, ids array<int>) for every row. A null text counts as empty: no ids. Rows with
    equal ids or texts, and null ids, are rows like others; further columns are dropped."""
    return _mapped(docs, _encode, id, text, vocabulary_path, pattern, "ids array<int>")


def encode_and_check(docs: DataFrame, vocabulary_path: str, pattern: str, id="doc_id", text="text"):
    """(id, ids, decoded_sha256) for every row: ``encode`` with the digest of the bytes that the
    ids decode to, in one pass, so neither ids nor bytes go to another worker."""
    return _mapped(
        docs, _encode_and_check, id, text, vocabulary_path, pattern, "ids array<int>, decoded_sha256 string"
    )


def decode(encoded: DataFrame, vocabulary_path: str, pattern: str, id="doc_id", ids="ids"):
    """(id, bytes binary) for every row; null ids give null, an unknown id an error."""
    return _mapped(encoded, _decode, id, ids, vocabulary_path, pattern, "bytes binary")


def round_trip(docs: DataFrame, vocabulary_path: str, pattern: str, id="doc_id", text="text"):
    """Encode every text, decode its ids again, and give digests of both:
    (id, n_tokens, ids_sha256 of the decimal ids joined by spaces, decoded_sha256)."""
    return _mapped(
        docs, _round_trip, id, text, vocabulary_path, pattern,
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
