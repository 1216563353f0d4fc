"""Which sources of a language use words differently, and which words tell them apart.

Counts of terms per (language, source) form a matrix. Comparing all sources of a language
term by term is a three-dimensional cube, source by source by term, and it is cut along all
three axes: a cell is (block of sources, block of sources, block of terms) and belongs to one
task, which gets the slices of the two source blocks over the term block. A slice is copied
once for each block of sources. Each cell gives partial divergences, which are summed along
the term axis. Terms that no source of a cell holds are not shipped: they all have the same
two shares, so their part follows from how many there are.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.tables import small, staged

#: Documents of a language that hold a term, at least, for it to be compared.
DOCUMENTS = 3
#: Sources and terms of a block, on average. A cell's matrix has twice as many sources.
SOURCES, TERMS = 16, 16384
#: Terms listed for each source.
LISTED = 200
#: Counts that a task adds up before it passes them on.
HELD = 300_000
#: Bytes of a text that are taken apart at once.
PIECE = 1 << 20

_LOW = bytes(texts.LOWER)
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text: str):
    """The terms of a text, in lists that PIECE bytes hold (or one term, if longer)."""
    data, at = text.encode().translate(_LOW), 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if inside := _TERM.match(data, end - 1):
            end = inside.end()
        yield _TERM.findall(data, at, end)
        at = end


def _counted(batches):
    """Rows: lang, source, text. Gives counts and documents of (lang, source, term)."""
    held: dict = {}

    def flushed():
        for (lang, source), (counts, holders) in held.items():
            size = len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                    pa.array([t.decode() for t in counts], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                    pa.array([holders[t] for t in counts], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    for batch in batches:
        for k in range(batch.num_rows):
            lang, source, text = (batch.column(i)[k].as_py() for i in range(3))
            counts, holders = held.setdefault((lang, source), (Counter(), Counter()))
            own: set = set()
            for found in _terms(text):
                counts.update(found)
                own.update(found)
            holders.update(own)
            if k % 64 == 0 and sum(len(c) for c, _ in held.values()) > HELD:
                yield from flushed()
    yield from flushed()


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total) in whole numbers, in two steps that do not overflow."""
    first = (counts + 1) * 100_000
    return 1 + first // totals * 10_000 + first % totals * 10_000 // totals


def _share(count: str, total: str) -> str:
    """The same as SQL."""
    first = f"({count} + 1) * 100000"
    return f"(1 + {first} div {total} * 10000 + {first} % {total} * 10000 div {total})"


def _cell(table: pa.Table) -> pa.Table:
    """Partial divergences of all pairs of a cell, both ways. A row without a term stands for
    a source as such."""
    sources, terms = (
        table[c].combine_chunks().dictionary_encode() for c in ("source", "term")
    )
    names = sources.dictionary
    row = sources.indices.to_numpy(zero_copy_only=False)
    column = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    size, totals = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    block = np.zeros(len(names), np.int64)
    size[row], block[row] = table["size"].to_numpy(), table["block"].to_numpy()
    kept = int(table["kept"][0].as_py())
    totals = np.maximum(size + kept, 1)
    counts = np.zeros((len(names), len(terms.dictionary)), np.int64)
    held = column >= 0
    counts[row[held], column[held]] = table["n"].to_numpy()[held]
    shares = _shares(counts, totals[:, None])
    low, high = (table[c][0].as_py() for c in ("low", "high"))
    left, right, sums = [], [], []
    for a in range(len(names)):
        others = np.arange(a + 1, len(names))
        if low != high:
            others = others[block[others] != block[a]]
        if not len(others):
            continue
        square = (shares[others] - shares[a]) ** 2
        left += [np.full(len(others), a), others]
        right += [others, np.full(len(others), a)]
        sums += [(square // shares[others]).sum(1), (square // shares[a]).sum(1)]
    left, right, sums = (
        np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right, sums)
    )
    return pa.table({
        "lang": pa.array([table["lang"][0].as_py()] * len(left), pa.string()),
        "source": names.take(pa.array(left)), "item": names.take(pa.array(right)),
        "size": size[left], "item_size": size[right],
        "kept": np.full(len(left), kept, np.int64),
        "part": sums.astype(np.int64),
        "terms": np.full(len(left), len(terms.dictionary), np.int64),
    })


def _pairs(counts: DataFrame, groups: DataFrame, sources: int, terms: int) -> DataFrame:
    """(lang, source, item, value) of all pairs of sources of a language."""
    placed = groups.selectExpr(
        "lang", "source", "size", "kept",
        f"cast(ceil(sources / {sources}) AS int) AS blocks",
        f"cast(greatest(ceil(kept / {terms}), 1) AS int) AS slabs",
    ).withColumn("block", F.expr("cast(pmod(xxhash64(source), blocks) AS int)"))
    sides = small(staged(placed, "sources"))
    held = counts.join(sides, ["lang", "source"]).withColumn(
        "slab", F.expr("cast(pmod(xxhash64(term), slabs) AS int)")
    ).select("lang", "source", "size", "kept", "blocks", "block", "slab", "term", "n")
    bare = sides.selectExpr(
        "lang", "source", "size", "kept", "blocks", "block",
        "explode(sequence(0, slabs - 1)) AS slab", "cast(NULL AS string) AS term", "0L AS n",
    )
    cells = held.unionByName(bare).withColumn("other", F.expr("explode(sequence(0, blocks - 1))"))
    partial = cells.selectExpr(
        "lang", "least(block, other) AS low", "greatest(block, other) AS high", "slab",
        "source", "size", "kept", "block", "term", "n",
    ).groupBy("lang", "low", "high", "slab").applyInArrow(
        _cell,
        "lang string, source string, item string, size long, item_size long, kept long, part long, terms long",
    )
    whole = partial.groupBy("lang", "source", "item", "size", "item_size", "kept").agg(
        F.sum("part").alias("part"), F.sum("terms").alias("terms")
    )
    nothing = {c: f"greatest({c} + kept, 1L)" for c in ("size", "item_size")}
    own, other = (_share("0L", total) for total in nothing.values())
    return whole.selectExpr(
        "lang", "source", "item",
        f"part + (kept - terms) * (({own} - {other}) * ({own} - {other}) div {other}) AS value",
    )


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    sources: int = SOURCES, terms: int = TERMS, listed: int = LISTED,
) -> DataFrame:
    """(lang, source, part, item, value, rank).

    A language keeps the terms that at least DOCUMENTS of its documents hold. A source's share
    of a kept term is p = 1 + floor(10^9 * (count + 1) / (all its counts + kept terms)), and its
    divergence from other shares q is the sum of floor((p - q)^2 / q) over kept terms. ``part``
    is ``pair`` with item another source of the language, all of them, or ``term`` with item a
    term that the source holds and uses more than the language does, the ``listed`` highest.
    Ranks begin with 1 for each source and part: highest values first, ties by the item's bytes.

    Every row is a document, so repeated rows and rows with one id or none all count. Null
    texts, languages and sources are empty ones; a source without terms is compared like any
    other (with no count at all); a language without kept terms has values of 0. Further
    columns are not looked at, an empty table gives no rows. Whole numbers are exact up to
    9 * 10^13 terms of a language.
    """
    source_rows = docs.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    found = source_rows.mapInArrow(
        _counted, "lang string, source string, term string, n long, docs long"
    ).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # as many rows as a language has sources
    of_term = Window.partitionBy("lang", "term")
    counts = staged(
        found.select(
            "lang", "source", "term", "n",
            F.sum("docs").over(of_term).alias("docs"), F.sum("n").over(of_term).alias("lang_n"),
            (F.row_number().over(of_term.orderBy("source")) == 1).alias("first"),
        ).where(F.col("docs") >= DOCUMENTS).drop("docs"),
        "counts",
    )
    sizes = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("size"), F.count_if("first").alias("kept")
    )
    # as many rows as there are sources; ranks need them by language anyway
    of_lang = Window.partitionBy("lang")
    groups = staged(
        source_rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").select(
            "lang", "source", F.coalesce("size", F.lit(0)).alias("size"),
            F.coalesce(F.sum("kept").over(of_lang), F.lit(0)).alias("kept"),
            F.coalesce(F.sum("size").over(of_lang), F.lit(0)).alias("lang_size"),
            F.count("*").over(of_lang).alias("sources"),
        ),
        "groups",
    )
    best = [F.col("value").desc(), F.col("item")]
    pairs = _pairs(counts, groups, sources, terms).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*best))
    )
    shares = counts.join(
        small(groups.select("lang", "source", "size", "lang_size", "kept")), ["lang", "source"]
    ).selectExpr(
        "lang", "source", "term AS item", f"{_share('n', '(size + kept)')} AS p",
        f"{_share('lang_n', '(lang_size + kept)')} AS q", f"pmod(xxhash64(term), kept div {terms} + 1) AS slab",
    ).where("p > q").selectExpr("lang", "source", "slab", "item", "(p - q) * (p - q) div q AS value")
    # a source's terms are ranked by slabs first
    told = shares.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source", "slab").orderBy(*best))
    ).where(F.col("rank") <= listed).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*best))
    ).where(F.col("rank") <= listed)
    parts = [
        df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
        for part, df in (("pair", pairs), ("term", told))
    ]
    return parts[0].unionByName(parts[1])
