"""Words that differ by one character, and the spelling each of them is a variant of.

Asymmetric q-chunks: a word gives two disjoint chunks, its halves; an edit of one character
leaves one of them whole. The other word gives its grams of that length, and those that lie
within a shift of one meet the chunk: at the same place if a character was replaced, and for
words one longer at the same place before the inserted character and one further after it.
So words are posted under what surrounds the half that may hold the edit. Where more than
``MANY`` words share a posting, the rule is applied again to the half left open: its own two
halves are two disjoint chunks, one of which the edit leaves whole. This goes on until groups
are small or the open part cannot be cut, so no group's size is squared whatever words share.
What meets is verified by the edit distance.
"""

import re
import zlib
from collections import Counter
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.tables import staged

LENGTH = 5
OCCURRENCES = 3
#: Words under one posting that are compared with each other.
MANY = 32
#: How much more frequent a form is than its variant.
FACTOR = 2
#: One run in this many, by a hash, loses a character.
ERRORS = 97
#: Counts that a task adds up before it passes them on.
HELD = 500_000
#: Characters of a text that are taken apart at once.
PIECE = 1 << 20

_LOW = bytes(texts.LOWER)
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _runs(text: str) -> Counter:
    """Occurrences of each run, lower-cased from A to Z, in UTF-8."""
    raw: Counter = Counter()
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if inside := _RUN.match(text, end - 1):
            end = inside.end()
        raw.update(_RUN.findall(text, at, end))
        at = end
    out: Counter = Counter()
    for run, n in raw.items():
        out[run.encode().translate(_LOW)] += n
    return out


def _counted(batches, errors):
    """Rows: id as text, text. Gives (word, n), added up over many rows."""
    held: Counter = Counter()

    def flushed():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
            names=["word", "n"],
        )
        held.clear()
        return batch

    for batch in batches:
        for id, text in zip(batch.column(0), batch.column(1)):
            start = zlib.crc32(f"{id.as_py() or ''}:".encode())
            for run, n in _runs(text.as_py() or "").items():
                h = zlib.crc32(run, start)
                word = run.decode()
                if h % errors == 0:
                    place = h % len(word)
                    word = word[:place] + word[place + 1 :]
                if len(word) >= LENGTH:
                    held[word] += n
            if len(held) > HELD:
                yield flushed()
    yield flushed()


def words(
    docs: DataFrame, id: str = "doc_id", text: str = "text", errors: int = ERRORS,
    occurrences: int = OCCURRENCES,
) -> DataFrame:
    """(word, n): runs of letters of at least LENGTH characters, and how often they occur.

    One run in ``errors`` of a document, by a hash of its id and the run, is taken to lack a
    character. A null id counts as an empty one, a null text has no runs.
    """
    found = docs.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
    return found.mapInArrow(partial(_counted, errors=errors), "word string, n long").groupBy(
        "word"
    ).agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


#: Roles of a word: of two words of one length, the shorter of two, the longer of two.
_SAME, _SHORT, _LONG = 0, 1, 2


def _key(role, low, high, short) -> str:
    """What surrounds the open part [low, high) of a word of ``short`` characters. A longer
    word has one more character in its open part. Hashed: what meets by chance is verified."""
    kind = f"least({role}, 1)"
    after = f"substr(word, {high} + 1 + if({role} = {_LONG}, 1, 0))"
    return f"xxhash64({kind}, {short}, {low}, {high}, substr(word, 1, {low}), {after})"


def _halves(role, low, high) -> str:
    """The open part cut into two, each left open in turn. A character can be inserted at
    either end of an open part, so before and after a single character, in an empty part."""
    middle = f"cast(({low} + {high}) div 2 AS int)"
    second = f"if({role} <> {_SAME} AND {high} - {low} = 1, {high}, {middle})"
    return f"array(struct({low} AS low, {middle} AS high), struct({second} AS low, {high} AS high))"


def near_words(found: DataFrame, many: int = MANY) -> DataFrame:
    """(a, b): pairs of words of ``found`` (word) at an edit distance of 1, each once, a < b
    by length, then by bytes."""
    sized = found.selectExpr("word", "cast(length(word) AS int) AS size")
    open_ = sized.selectExpr(
        "word", "size", f"explode(array({_SAME}, {_SHORT}, {_LONG})) AS role"
    ).selectExpr("word", "role", f"if(role = {_LONG}, size - 1, size) AS short").selectExpr(
        "word", "role", "short", f"explode({_halves('role', '0', 'short')}) AS part"
    ).selectExpr("word", "role", "short", "part.low AS low", "part.high AS high")
    ready = None
    while True:
        posted = staged(open_.withColumn("key", F.expr(_key("role", "low", "high", "short"))), "posted")
        # a replaced character needs one to replace, an inserted one does not
        splits = f"high - low > if(role = {_SAME}, 1, 0)"
        groups = posted.groupBy("key").agg(
            F.count("*").alias("n"), F.max(F.expr(splits)).alias("splits"),
            (F.count_if(F.col("role") == _SHORT) * F.count_if(F.col("role") == _LONG)
             + F.count_if(F.col("role") == _SAME) * (F.count_if(F.col("role") == _SAME) - 1)).alias("meet"),
        ).where("meet > 0")
        posted = staged(posted.join(groups.repartition("key"), "key"), "groups")
        done = posted.where(f"n <= {many} OR NOT splits").select("key", "word", "role")
        ready = done if ready is None else ready.unionByName(done)
        larger = posted.where(f"n > {many} AND splits")
        if larger.isEmpty():
            break
        open_ = larger.selectExpr(
            "word", "role", "short", f"explode({_halves('role', 'low', 'high')}) AS part"
        ).selectExpr("word", "role", "short", "part.low AS low", "part.high AS high")
    left = ready.where(f"role <> {_LONG}").selectExpr("key", "role", "word AS a")
    right = ready.where(f"role <> {_SHORT}").selectExpr("key", "least(role, 1) AS role", "word AS b")
    return left.join(right, ["key", "role"]).where(
        f"(role <> {_SAME} OR a < b) AND levenshtein(a, b, 1) = 1"
    ).select("a", "b").distinct()


def variants(
    docs: DataFrame, id: str = "doc_id", text: str = "text", errors: int = ERRORS,
    occurrences: int = OCCURRENCES, many: int = MANY,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``words``.

    Near words differ by exactly one inserted, deleted or replaced character. A word's form is
    the most frequent of them (ties: the first by code points) if that is FACTOR times as frequent as the
    word; root is where forms lead in the end, the word itself if it has none. Repeated rows
    and rows with one id or none all count; null and empty texts add nothing; further columns
    are not looked at; no documents, no words.
    """
    counted = staged(words(docs, id, text, errors, occurrences), "words")
    near = staged(near_words(counted.select("word"), many), "near")
    both = near.selectExpr("a AS word", "b AS other").unionByName(
        near.selectExpr("b AS word", "a AS other")
    )
    # frequencies of the other word come to each pair; then one row a word
    best = both.join(counted.selectExpr("word AS other", "n AS other_n"), "other").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("other_n"), "other")).alias("best")
    ).selectExpr("word", "n_near", "best.other AS other", f"-best.col1 AS other_n")
    formed = staged(
        counted.join(best, "word", "left").withColumn("is_form", F.expr(f"other_n >= {FACTOR} * n")).selectExpr(
            "word", "if(is_form, other, NULL) AS form", "n", "coalesce(n_near, 0L) AS n_near",
            "if(is_form, other_n, NULL) AS form_n",
        ),
        "formed",
    )
    # each step at least doubles n, so ways are short, and each round doubles their steps
    roots = formed.where("form IS NOT NULL").selectExpr("word", "form AS root")
    while True:
        on = roots.selectExpr("word AS root", "root AS further")
        roots = staged(
            roots.join(on, "root", "left").selectExpr(
                "word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved"
            ),
            "roots",
        )
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return formed.join(roots.select("word", "root"), "word", "left").selectExpr(
        "word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n"
    )
