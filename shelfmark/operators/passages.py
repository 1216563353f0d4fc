"""Passages cut by content, so that a change in a text moves few of them.

A rolling hash over the last ``WINDOW`` characters says where a passage may end. The hash
forgets what came before, so an inserted or deleted sentence changes the passages it touches
and those up to the next common end; all others keep their text, and with it their key.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 16
#: One place in this many may end a passage; passages are LEAST to MOST characters long.
PLACES, LEAST, MOST = 512, 256, 4096
BASE, PRIME = 257, 1_000_003
FACTORS = [pow(BASE, j, PRIME) for j in range(WINDOW)]
#: Characters of a text that are hashed at once.
BLOCK = 1 << 20


def ends(text: str) -> list[int]:
    """Where the passages of a text end, in characters."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    places = []
    for low in range(0, len(codes), BLOCK):
        high = min(low + BLOCK, len(codes))
        first = max(0, low - WINDOW + 1)
        own = codes[first:high].astype(np.int64)
        sums = np.zeros(len(own), np.int64)
        for j, factor in enumerate(FACTORS[: len(own)]):
            sums[j:] += own[: len(own) - j] * factor
        places.append(low + 1 + np.flatnonzero((sums % PRIME % PLACES == 0)[low - first :]))
    places = np.concatenate(places) if places else np.zeros(0, np.int64)
    out, begin = [], 0
    while begin < len(codes):
        end = begin + MOST
        at = int(np.searchsorted(places, begin + LEAST))
        if at < len(places):
            end = min(end, int(places[at]))
        out.append(min(end, len(codes)))
        begin = out[-1]
    return out


def _cut(batches):
    """Rows: row, text. Gives the passages of each row."""
    for batch in batches:
        for k in range(batch.num_rows):
            text = batch.column(1)[k].as_py() or ""
            bounds = [0, *ends(text)]
            n = len(bounds) - 1
            if n:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([k] * n)), pa.array(range(n), pa.int32()),
                        pa.array(bounds[:-1], pa.int64()),
                        pa.array([text[a:b] for a, b in zip(bounds, bounds[1:])], pa.string()),
                    ],
                    names=["row", "chunk_no", "location", "chunk"],
                )


def content_chunks(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per passage: the columns of ``texts`` but for the text, chunk_no, location (the
    first character's offset), chunk and chunk_key (its SHA-256).

    Joined by chunk_no the chunks are the whole text. Null and empty texts have none.
    """
    others = [c for c in texts.columns if c != text]
    source = texts.select(F.struct(*others).alias("row"), F.col(text).alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    found = source.mapInArrow(_cut, f"row {kind}, chunk_no int, location long, chunk string")
    return found.select("row.*", "chunk_no", "location", "chunk", F.sha2("chunk", 256).alias("chunk_key"))


def to_embed(passages: DataFrame, embedded: DataFrame) -> DataFrame:
    """(corpus, chunk_key, n_chars, path): passages that a corpus holds and ``embedded`` (corpus,
    chunk_key) does not, each once however many files hold it, with the first of them.

    The key is the passage's own content, so files without a hash are no special case.
    """
    keys = ["corpus", "chunk_key"]
    wanted = passages.groupBy(*keys).agg(
        F.first(F.length("chunk").cast("long")).alias("n_chars"), F.min("path").alias("path")
    )
    return wanted.join(embedded.select(keys).distinct(), keys, "left_anti")
