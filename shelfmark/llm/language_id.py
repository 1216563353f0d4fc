"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ORDER bytes, with counts of the byte that
follows. A byte's probability comes from the longest context of the tree that precedes it; a
byte not seen there costs an escape and is looked for after the next shorter context, where
what the longer one has seen is left out; in the end all bytes left are alike. (Method C: a
context escapes with as many counts as it has different bytes.) So the probabilities that
follow a context sum to one, and the logarithms summed over a text are its exact code length
in that language. Statistics are frozen after training: scoring adds nothing to them.

Counts come from all training documents: runs of ORDER + 1 bytes are counted, and all shorter
contexts follow from these counts. Of the tree only contexts met often enough are kept, so
many that a model has at most ENTRIES counts in all languages together; a context's suffixes
are met at least as often, so no way back to the root is cut. A code length depends on
ORDER + 1 bytes only, so a worker computes it once for each different run in a slice of texts.
"""

import uuid
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.tables import small, staged

#: Bytes of the longest context; with the byte that follows, a run fits 40 bits.
ORDER = 4
#: Counts of all languages' trees together; the model's broadcast takes 16 bytes for each.
ENTRIES = 1_000_000
#: Code lengths are whole numbers of this part of a bit, so sums do not depend on their order.
UNIT = 1 << 20
#: Bytes of texts that are looked at together.
BLOCK = 4 << 20
UNKNOWN = "und"


def _blocks(data: np.ndarray, offsets: np.ndarray):
    """(row of each byte, run of ORDER + 1 bytes that ends there) over blocks of the data.
    Bytes before a text's first count as zeros."""
    for low in range(0, len(data), BLOCK):
        high = min(low + BLOCK, len(data))
        at = np.arange(low, high)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at - offsets[row]
        runs = data[low:high].astype(np.int64)
        for k in range(1, ORDER + 1):
            before = np.zeros(high - low, np.int64)
            skip = max(0, k - low)
            before[skip:] = data[low + skip - k : high - k]
            before[inside < k] = 0
            runs |= before << (8 * k)
        yield row, runs


def _runs(batches):
    """Rows: lang, text. Gives (lang, run, n), added up over a slice of texts."""
    for batch in batches:
        for low, high in texts.slices(batch.column(1), BLOCK):
            langs = batch.column(0).slice(low, high - low).dictionary_encode()
            code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = texts.raw(batch.column(1).slice(low, high - low))
            for row, runs in _blocks(data, offsets):
                for k in range(len(langs.dictionary)):
                    own, n = np.unique(runs[code[row] == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [langs.dictionary.take(pa.array(np.full(len(own), k))), pa.array(own), pa.array(n)],
                        names=["lang", "run", "n"],
                    )


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", entries: int = ENTRIES) -> DataFrame:
    """(lang, size, run, n): how often the last byte of ``run`` follows the ``size`` bytes before it.

    A language without a single byte has a row with a null run. Rows without a language teach
    nothing. A language keeps the contexts met at least t times, t the least power of two with
    which its share of ``entries`` holds their counts; without any context it knows no byte.
    """
    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL")
    langs = staged(known.select("lang").distinct(), "langs")
    runs = known.where("text <> ''").mapInArrow(_runs, "lang string, run long, n long").groupBy(
        "lang", "run"
    ).agg(F.sum("n").alias("n"))
    counts = runs.withColumn("size", F.expr(f"explode(sequence(0, {ORDER}))")).select(
        "lang", "size", F.expr("run & (shiftleft(1L, 8 * (size + 1)) - 1)").alias("run"), "n"
    ).groupBy("lang", "size", "run").agg(F.sum("n").alias("n"))
    counts = staged(counts.withColumn("context", F.expr("shiftright(run, 8)")), "runs")
    contexts = counts.groupBy("lang", "size", "context").agg(
        F.sum("n").alias("met"), F.count("*").alias("different")
    ).withColumn("level", F.expr("cast(floor(log2(met)) AS int)"))
    # at most 63 levels for each language
    levels = contexts.groupBy("lang", "level").agg(F.sum("different").alias("different")).withColumn(
        "held", F.sum("different").over(Window.partitionBy("lang").orderBy(F.desc("level")))
    )
    share = entries // max(1, langs.count())
    least = levels.where(F.col("held") <= share).groupBy("lang").agg(F.min("level").alias("least"))
    kept = contexts.join(small(staged(least, "least")), "lang").where("level >= least").select("lang", "size", "context")
    held = counts.join(kept, ["lang", "size", "context"]).select("lang", "size", "run", "n")
    return langs.join(held, "lang", "left").select("lang", "size", "run", "n")


class Tree:
    """The contexts of one language as sorted arrays for each size."""

    def __init__(self, size: np.ndarray, run: np.ndarray, n: np.ndarray):
        self.runs, self.counts, self.contexts, self.cost, self.escape = [], [], [], [], []
        self.inner_cost, self.inner_escape = [], []
        met, different, first = [], [], []
        for k in range(ORDER + 1):
            own = np.flatnonzero(size == k)
            own = own[np.argsort(run[own])]
            self.runs.append(run[own])
            self.counts.append(n[own])
            context, at, d = np.unique(run[own] >> 8, return_index=True, return_counts=True)
            self.contexts.append(context)
            met.append(np.add.reduceat(n[own], at) if len(at) else np.zeros(0, np.int64))
            different.append(d)
            first.append(at)
        for k in range(ORDER + 1):
            # reached first: all its counts and an escape for each different byte
            self.cost.append(met[k] + different[k])
            self.escape.append(different[k])
            # the next shorter context, reached by an escape from this one
            if not k or not len(self.contexts[k]):
                self.inner_cost.append(np.zeros(0, np.int64))
                self.inner_escape.append(np.zeros(0, np.int64))
                continue
            mask = (1 << (8 * k)) - 1
            seen = self.counts[k - 1][np.searchsorted(self.runs[k - 1], self.runs[k] & mask)]
            seen = np.add.reduceat(seen, first[k])
            parent = np.searchsorted(self.contexts[k - 1], self.contexts[k] & (mask >> 8))
            left = different[k - 1][parent] - different[k]
            self.inner_cost.append(met[k - 1][parent] - seen + left)
            self.inner_escape.append(left)
        self.rest = 256 - (int(different[0][0]) if len(different[0]) else 0)

    def lengths(self, runs: np.ndarray) -> np.ndarray:
        """Code lengths in bits of the last byte of each run after the bytes before it."""
        out = np.zeros(len(runs))
        todo = np.arange(len(runs))
        came = np.full(len(runs), -1)  # the context escaped from, one size up
        for k in range(ORDER, -1, -1):
            if not len(self.contexts[k]) or not len(todo):
                continue
            own, from_ = runs[todo], came[todo]
            context = (own >> 8) & ((1 << (8 * k)) - 1)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            here = self.contexts[k][at] == context
            inner = from_ >= 0
            cost, escape = self.cost[k][at], self.escape[k][at]
            if k < ORDER and inner.any():
                cost[inner] = self.inner_cost[k + 1][from_[inner]]
                escape[inner] = self.inner_escape[k + 1][from_[inner]]
            full = own & ((1 << (8 * (k + 1))) - 1)
            place = np.minimum(np.searchsorted(self.runs[k], full), len(self.runs[k]) - 1)
            hit = here & (self.runs[k][place] == full)
            miss = here & ~hit
            out[todo[hit]] += np.log2(cost[hit] / self.counts[k][place[hit]])
            paid = miss & (escape > 0)  # where no other byte is left, the escape is certain
            out[todo[paid]] += np.log2(cost[paid] / escape[paid])
            came[todo[miss]] = at[miss]
            todo = todo[~hit]
        out[todo] += np.log2(self.rest)
        return out


_OPEN: dict = {}


def _trees(model) -> list[Tree]:
    key, arrays = model.value
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = [Tree(*x) for x in arrays]
    return _OPEN[key]


def _scored(batches, model):
    """Rows: row, text. Gives code lengths in all languages."""
    trees = _trees(model)
    for batch in batches:
        for low, high in texts.slices(batch.column(1), BLOCK):
            part = batch.slice(low, high - low)
            data, offsets = texts.raw(part.column(1))
            sums = np.zeros((len(trees), part.num_rows), np.int64)
            for row, runs in _blocks(data, offsets):
                own, place = np.unique(runs, return_inverse=True)
                begin, first = np.unique(row, return_index=True)
                for k, tree in enumerate(trees):
                    length = np.rint(tree.lengths(own) * UNIT).astype(np.int64)
                    sums[k, begin] += np.add.reduceat(length[place], first)
            ends = pa.array(np.arange(part.num_rows + 1) * len(trees), pa.int32())
            lengths = pa.ListArray.from_arrays(ends, pa.array(sums.T.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), lengths], names=["row", "lengths"])


def code_lengths(docs: DataFrame, model: DataFrame) -> tuple[list[str], DataFrame]:
    """The languages, and for each row (row, text) of ``docs`` (row, lengths): code lengths of
    the text in UNITs of a bit, in the order of the languages.

    ``model`` is the result of ``learn``; at most ENTRIES rows and one for each language come
    to the driver, and go to the tasks.
    """
    rows = staged(model, "trees").toArrow()
    langs = sorted(set(rows["lang"].to_pylist()))
    arrays = []
    for lang in langs:
        own = rows.filter(pc.equal(rows["lang"], lang)).drop_null()
        arrays.append(tuple(own[c].to_numpy().astype(np.int64) for c in ("size", "run", "n")))
    # the name tells models apart in workers that serve several
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, arrays))
    kind = docs.schema["row"].dataType.simpleString()
    return langs, docs.select("row", "text").mapInArrow(
        partial(_scored, model=shared), f"row {kind}, lengths array<long>"
    )


def predict(
    docs: DataFrame, held_out: str, id: str = "doc_id", text: str = "text", lang: str = "lang",
    entries: int = ENTRIES,
) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row.

    Learned from rows with a language for which the SQL condition ``held_out`` is not true.
    lang_pred has the shortest code length for the whole text (ties: the smallest name), score
    is its probability if all languages were equally likely before. A text that is null or has
    no letter is ``und`` with score 0, and so is every text where no language was learned; with
    one language every other text is that, with score 1. A null condition counts as true.
    Repeated rows and rows with one id or none are rows like others, further columns are not
    looked at.
    """
    source = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"),
        F.coalesce(F.expr(held_out), F.lit(True)).alias("held_out"),
    )
    model = learn(source.where("NOT held_out"), entries=entries)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    langs, found = code_lengths(
        source.select(
            F.struct("id", "held_out", lettered.alias("lettered")).alias("row"),
            F.when(lettered, F.col("text")).alias("text"),  # others need no code length
        ),
        model,
    )
    least = F.array_min("lengths")
    weight = F.aggregate("lengths", F.lit(0.0), lambda s, x: s + F.pow(F.lit(2.0), (least - x) / UNIT))
    known = F.col("row.lettered") & (F.size("lengths") > 0)
    best = F.get(F.array(*map(F.lit, langs or [UNKNOWN])), F.array_position("lengths", least).cast("int") - 1)
    return found.select(
        F.col("row.id").alias(id), F.col("row.held_out").alias("held_out"),
        F.when(known, best).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, 1 / weight).otherwise(0.0).alias("score"),
    )
