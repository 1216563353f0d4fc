"""Token counts of a unigram tokenizer, without its tokens.

An Aho-Corasick automaton enumerates the vocabulary's pieces that end at each character;
the best score and the number of tokens on the way to it are carried along, no path is
kept. Scores are compared as doubles summed from the text's beginning. In a text so short that no sum of
its scores can be rounded (``exact_length``), marks split it and equal parts are counted once; any other
is gone through whole, since rounding decides ties. Results are the same either way. Of equally good ways the one
whose last piece begins first is taken; a character that is no piece by itself may be
unknown at the least piece's score less ten, and becomes its bytes if the vocabulary has
byte pieces, while without them a run of unknown characters is one token.
"""

import uuid
from array import array
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.chunks import Encoder

MARK = "▁"
UNKNOWN_PENALTY = 10.0
SLICE = 8 << 20


def exact_length(scores: list[float]) -> int:
    """Up to how many of these scores doubles add without ever rounding; none if they are no
    multiples of a power of two."""
    most = max(map(abs, scores), default=0.0)
    for bits in range(23):
        if all((s * 2**bits).is_integer() for s in scores):
            return int(2**53 // max(1.0, most * 2**bits))
    return 0


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.byte_pieces = byte_pieces
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        if len(self.automaton):
            self.automaton.make_automaton()
        inner = any(MARK in p.lstrip(MARK) for p, _ in pieces)
        #: Marks split texts up to this length, if no piece goes on after a mark that follows something else.
        self.most = 0 if inner else exact_length([s for _, s in pieces] + [self.unknown])
        self.splits = self.most > 0

    def count(self, text: str) -> int:
        """Tokens of normalized text."""
        n = len(text)
        best, tokens = array("d", bytes(8 * (n + 1))), array("q", bytes(8 * (n + 1)))
        open_run = bytearray(n + 1)
        found = self.automaton.iter(text) if len(self.automaton) else iter(())
        end, piece = next(found, (n, None))
        for i in range(n):
            top, first, single = None, 0, False
            while end == i:
                size, score = piece
                begin, single = i + 1 - size, single or size == 1
                total = best[begin] + score
                if top is None or total > top or (total == top and begin < first):
                    top, first = total, begin
                end, piece = next(found, (n, None))
            if not single and (top is None or best[i] + self.unknown > top):
                best[i + 1] = best[i] + self.unknown
                open_run[i + 1] = not self.byte_pieces
                more = len(text[i].encode()) if self.byte_pieces else 1 - open_run[i]
                tokens[i + 1] = tokens[i] + more
            else:
                best[i + 1], tokens[i + 1] = top, tokens[first] + 1
        return tokens[n]


def pieces_of(model_path: str) -> tuple[list[tuple[str, float]], bool]:
    """The ordinary pieces and scores of a model file, and whether it has byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain], any(map(model.is_byte, ids))


def _at_marks(data: np.ndarray, offsets: np.ndarray, most: int) -> np.ndarray:
    """Where chunks begin: at texts' beginnings, and in texts of up to ``most`` bytes at spaces that
    follow something else."""
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    for i in np.flatnonzero(np.diff(offsets) > most):
        cut[offsets[i] : offsets[i + 1]] = False
    cut[np.unique(offsets)] = True
    return np.flatnonzero(cut[: len(data)])


_OPEN: dict = {}


def _counter(vocabulary) -> Encoder:
    key, pieces, byte_pieces = vocabulary.value
    if key not in _OPEN:
        _OPEN.clear()
        own = Counter(pieces, byte_pieces)
        _OPEN[key] = Encoder(
            lambda chunks: [[own.count(c.replace(" ", MARK))] for c in chunks],
            partial(_at_marks, most=own.most),
        )
    return _OPEN[key]


def _counts(batches, vocabulary):
    counter = _counter(vocabulary)
    for batch in batches:
        for low, high in texts.slices(batch.column(1), SLICE):
            column = pc.fill_null(batch.column(1).slice(low, high - low), "")
            marked = pc.binary_join_element_wise(" ", pc.replace_substring(column, MARK, " "), "")
            column = pc.if_else(pc.equal(column, ""), "", marked)
            counts, rows = counter(column)
            sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low),
                    pa.array(sums[rows[1:]] - sums[rows[:-1]], pa.int64()),
                ],
                names=["id", "n_tokens"],
            )


def token_counts(docs: DataFrame, pieces, byte_pieces: bool, id="doc_id", text="text") -> DataFrame:
    """(id, n_tokens) for every row. ``pieces``: (piece, score) of the vocabulary.

    A text is normalized by a mark before it and marks for its spaces. A null or empty text
    has no tokens. Repeated rows and null ids are rows like others; further columns are not
    looked at; an empty vocabulary leaves unknown characters only.
    """
    # the name tells vocabularies apart in workers that serve several
    vocabulary = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, list(pieces), byte_pieces))
    kind = docs.schema[id].dataType.simpleString()
    found = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(
        partial(_counts, vocabulary=vocabulary), f"id {kind}, n_tokens long"
    )
    return found.withColumnRenamed("id", id)
