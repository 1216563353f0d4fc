"""Scores of texts by a class-based bigram model.

A text is words and one end. Every word of the training texts belongs to one of
``CLASSES`` classes or to the class of all other words, the end to its own. A token's
probability is that of its class after the class before (smoothed by ``SMOOTHING``) times
that of the token in its class; in the class of other words every word counts one more, and
one place is for words not seen. The ``CLUSTERED`` most frequent words are clustered by
exchange: each round gives every second word the class that raises the likelihood most,
other words as they are; a round that lowers it ends the exchange. Then every further word,
out of the class of other words, takes the class that raises the likelihood most, all at
once: its neighbours are counted in one shuffle of the texts' words, whatever their number.

Words are told apart by two independent 64-bit hashes. Counts cover all training texts.
The ``LOOKUP`` words or fewer with the highest counts are broadcast for scoring; a text's
other words meet their counts and classes in a join, and its chain of classes (a byte a
token) is filled in by their places.
"""

import math
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.tables import staged

CLUSTERED = 4096
CLASSES = 64
ROUNDS = 6
SMOOTHING = 0.5
LOOKUP = 1_000_000
SLICE = 8 << 20
#: Counts of pairs that a task holds before it hands them on.
HELD = 1_000_000
OTHER, END = CLUSTERED, CLUSTERED + 1
STATES = CLASSES + 2
#: Beside the states: the word itself as its own neighbour, and a word that was not looked up.
ITSELF, NOT_FOUND = STATES, 255


def _words(column: pa.Array):
    data, offsets = texts.raw(column)
    data = texts.LOWER[data]
    starts, ends, rows = texts.spans(data, offsets, texts.SPACES)
    return texts.hashes(data, starts, ends), texts.hashes(data, starts, ends, second=True), rows


def _count_words(batches):
    for batch in batches:
        for low, high in texts.slices(batch.column(0), SLICE):
            a, b, _ = _words(batch.column(0).slice(low, high - low))
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            fresh = np.ones(len(a), bool)
            fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = np.flatnonzero(fresh)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[at].view(np.int64)), pa.array(b[at].view(np.int64)),
                 pa.array(np.diff(np.append(at, len(a))), pa.int64())],
                names=["a", "b", "n"],
            )


class Lookup:
    """Words with a number each."""

    def __init__(self, a: np.ndarray, b: np.ndarray, number: np.ndarray):
        order = np.lexsort((b, a))
        self.order = order
        self.a, self.b, self.number = a[order], b[order], number[order]

    def find(self, a: np.ndarray, b: np.ndarray):
        """Place of each word, and whether it is there."""
        if not len(self.a):
            return np.zeros(len(a), np.int64), np.zeros(len(a), bool)
        at = np.minimum(np.searchsorted(self.a, a), len(self.a) - 1)
        found = (self.a[at] == a) & (self.b[at] == b)
        # words that share the first hash lie side by side
        again = np.flatnonzero(~found & (self.a[at] == a))
        for i in again:
            j = at[i]
            while j < len(self.a) and self.a[j] == a[i]:
                if self.b[j] == b[i]:
                    at[i], found[i] = j, True
                j += 1
        return at, found

    def numbers(self, a, b):
        at, found = self.find(a, b)
        return np.where(found, self.number[at] if len(self.number) else OTHER, OTHER)

    @classmethod
    def of(cls, table: pa.Table, number: np.ndarray):
        return cls(*(table[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("a", "b")), number)


def _sequence(numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All texts one after the other, with an end after each."""
    return np.insert(numbers, rows[1:], END)


def _count_pairs(batches, lookup):
    held = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["pair", "n"])

    for batch in batches:
        for low, high in texts.slices(batch.column(0), SLICE):
            a, b, rows = _words(batch.column(0).slice(low, high - low))
            line = _sequence(lookup.value.numbers(a, b), rows).astype(np.int64)
            before = np.concatenate([[END], line[:-1]])
            pairs, counts = np.unique(before * (END + 1) + line, return_counts=True)
            keys, inverse = np.unique(np.concatenate([held[0], pairs]), return_inverse=True)
            sums = np.bincount(inverse, np.concatenate([held[1], counts]), len(keys)).astype(np.int64)
            held = keys, sums
            if len(keys) > HELD:
                yield out()
                held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield out()


def _plogp(x):
    x = np.asarray(x, float)
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def _moves(batches, matrix, classes):
    """For each word, the class that raises the likelihood most, and by how much.

    Rows: word, and lists of (side, class, n): tokens before it (0) or after it (1).
    """
    table, own = np.array(matrix.value, float), classes.value
    left, right = table.sum(0), table.sum(1)
    empty = left[:CLASSES] == 0  # words of all kinds would go there at once
    for batch in batches:
        words, targets, gains = [], [], []
        for word, around in zip(*(c.to_pylist() for c in batch.columns)):
            before, after, itself = np.zeros(STATES), np.zeros(STATES), 0.0
            for x in around:
                if x["side"] == 2:
                    itself += x["n"]
                elif x["side"]:
                    after[x["state"]] += x["n"]
                else:
                    before[x["state"]] += x["n"]
            home, total = own[word], after.sum() + itself
            # the table without the word, then the word in each class by turns
            rest = table.copy()
            rest[:, home] -= before
            rest[home, :] -= after
            rest[home, home] -= itself
            base_left, base_right = left.copy(), right.copy()
            base_left[home] -= before.sum() + itself
            base_right[home] -= total
            rows, columns = _plogp(rest), _plogp(base_left) + _plogp(base_right)
            # only row and column of the class change
            with_before, with_after = _plogp(rest + before[:, None]), _plogp(rest + after[None, :])
            down = (with_before - rows).sum(0)
            across = (with_after - rows).sum(1)
            corner = np.diag(rest)
            added = _plogp(corner + before + after + itself)
            fix = added - np.diag(rows) - (np.diag(with_before) - np.diag(rows)) - (np.diag(with_after) - np.diag(rows))
            sides = (_plogp(base_left + before.sum() + itself) + _plogp(base_right + total)) - columns
            score = (down + across + fix - sides)[:CLASSES]
            score[empty & (np.arange(CLASSES) != home)] = -np.inf
            best = int(score.argmax())
            words.append(word)
            targets.append(best)
            gains.append(float(score[best] - score[home]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.int32()), pa.array(targets, pa.int32()), pa.array(gains, pa.float64())],
            names=["word", "target", "gain"],
        )


def _cluster(pairs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each word, OTHER and END, and the table of class pairs.

    ``pairs``: (v, w, n). The driver holds one number per clustered word and the table.
    """
    spark = pairs.sparkSession
    context = spark.sparkContext
    own = np.concatenate([np.arange(CLUSTERED) % CLASSES, [CLASSES, CLASSES + 1]]).astype(np.int32)

    def table(own):
        state = F.broadcast(spark.createDataFrame(list(enumerate(own.tolist())), "word int, state int"))
        placed = pairs.join(state.selectExpr("word AS v", "state AS cv"), "v").join(
            state.selectExpr("word AS w", "state AS cw"), "w"
        )
        out = np.zeros((STATES, STATES), np.int64)
        for r in placed.groupBy("cv", "cw").agg(F.sum("n").alias("n")).collect():
            out[r["cv"], r["cw"]] = r["n"]
        return out, placed

    def likelihood(t):
        return _plogp(t).sum() - _plogp(t.sum(0)).sum() - _plogp(t.sum(1)).sum()

    now, placed = table(own)
    for turn in range(ROUNDS):
        around = placed.selectExpr(
            "inline(CASE WHEN v = w THEN array(named_struct('word', v, 'side', 2, 'state', cv, 'n', n)) ELSE "
            "array(named_struct('word', w, 'side', 0, 'state', cv, 'n', n), "
            "named_struct('word', v, 'side', 1, 'state', cw, 'n', n)) END)"
        ).where(f"word < {size} AND word % 2 = {turn % 2}")
        around = around.groupBy("word", "side", "state").agg(F.sum("n").alias("n")).groupBy("word").agg(
            F.collect_list(F.struct("side", "state", "n")).alias("around")  # at most 2 * STATES + 1
        )
        moves = around.mapInArrow(
            partial(_moves, matrix=context.broadcast(now.tolist()), classes=context.broadcast(own.tolist())),
            "word int, target int, gain double",
        ).where("gain > 0")
        changed = own.copy()
        for r in moves.collect():  # at most CLUSTERED rows
            changed[r["word"]] = r["target"]
        if (changed == own).all():
            if turn % 2:
                break
            continue
        after, placed_after = table(changed)
        if likelihood(after) < likelihood(now):
            break
        own, now, placed = changed, after, placed_after
    return own, now


def _around(batches, top, classes):
    """For each word of a slice that is not in ``top``: the states before and after it, as a
    16-bit number for each time that it occurs."""
    for batch in batches:
        for low, high in texts.slices(batch.column(0), SLICE):
            a, b, rows = _words(batch.column(0).slice(low, high - low))
            if not len(a):
                continue
            numbers = top.value.numbers(a, b)
            states = classes.value[numbers].astype(np.int16)
            before, after = np.empty(len(a), np.int16), np.empty(len(a), np.int16)
            before[1:], after[:-1] = states[:-1], states[1:]
            same = np.flatnonzero((a[1:] == a[:-1]) & (b[1:] == b[:-1]))
            before[same + 1] = after[same] = ITSELF
            filled = rows[:-1] < rows[1:]
            before[rows[:-1][filled]] = after[rows[1:][filled] - 1] = CLASSES + 1
            others = np.flatnonzero(numbers == OTHER)
            # words that share the first hash may come in several rows
            others = others[np.argsort(a[others], kind="stable")]
            a, b = a[others], b[others]
            codes = before[others] * np.int16(STATES + 1) + after[others]
            first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)])
            ends = (np.append(first, len(a)) * 2).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[first].view(np.int64)), pa.array(b[first].view(np.int64)),
                 pa.BinaryArray.from_buffers(
                     pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(codes)]
                 )],
                names=["a", "b", "around"],
            )


def _best(before: np.ndarray, after: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For words of the class of other words, the class that raises the likelihood most; that
    class itself where none does. Rows: counts of the states before and after a word, the word
    itself as the last."""
    itself = before[:, ITSELF].astype(float)
    n = before.sum(1).astype(float)
    left, right = table.sum(0), table.sum(1)
    score = np.zeros((len(n), CLASSES))
    # cells of a class with states other than those of other words stay as they are without the word
    for around, cells in ((before, table), (after, table.T)):
        word, state = np.nonzero(around[:, :STATES])
        keep = state != CLASSES
        word, state = word[keep], state[keep]
        kinds, place = np.unique(around[word, state] * STATES + state, return_inverse=True)
        held = cells[kinds % STATES, :CLASSES]
        gain = _plogp(held + (kinds // STATES)[:, None]) - _plogp(held)
        for c in range(CLASSES):
            score[:, c] += np.bincount(word, gain[place, c], len(n))
    # those with other words hold the word's own other side as well
    for around, opposite, cells in ((before, after, table[CLASSES]), (after, before, table[:, CLASSES])):
        word = np.flatnonzero(around[:, CLASSES])
        held = cells[:CLASSES] - opposite[word, :CLASSES]
        score[word] += _plogp(held + around[word, CLASSES][:, None]) - _plogp(held)
    corner = np.diag(table)[:CLASSES]
    word, c = np.nonzero(((before[:, :CLASSES] > 0) & (after[:, :CLASSES] > 0)) | (itself > 0)[:, None])
    x, y, z = before[word, c], after[word, c], corner[c]
    score[word, c] += _plogp(z + x + y + itself[word]) - _plogp(z + x) - _plogp(z + y) + _plogp(z)
    sizes, place = np.unique(n, return_inverse=True)
    sides = sum(_plogp(s[:CLASSES] + sizes[:, None]) - _plogp(s[:CLASSES]) for s in (left, right))
    score -= sides[place]
    score[:, left[:CLASSES] == 0] = -np.inf  # words of all kinds would go there at once
    # to stay: the class of other words with the word, less that without it
    rows = [x for x in range(STATES) if x != CLASSES]
    stay = sum(
        (_plogp(cells[rows]) - _plogp(cells[rows] - around[:, rows])).sum(1)
        for around, cells in ((before, table[:, CLASSES]), (after, table[CLASSES]))
    )
    whole = table[CLASSES, CLASSES]
    stay += _plogp(whole) - _plogp(whole - before[:, CLASSES] - after[:, CLASSES] - itself)
    stay -= sum(_plogp(s[CLASSES]) - _plogp(s[CLASSES] - n) for s in (left, right))
    best = score.argmax(1)
    return np.where(score[np.arange(len(n)), best] > stay, best, CLASSES)


def _placed(batches, matrix):
    """Rows of ``_around``, sorted by word. Gives each word's count and class. Of a word that goes
    on in the next batch its counts by state stay."""
    table, width, kept = np.array(matrix.value, float), STATES + 1, None

    def out(a, b, before, after):
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), pa.array(before.sum(1)), pa.array(_best(before, after, table).astype(np.int32))],
            names=["a", "b", "n", "state"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch.column(i).to_numpy() for i in range(2))
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        column = batch.column(2)
        codes = np.frombuffer(b"".join(column.to_pylist()), np.int16).astype(np.int64)
        word = np.repeat(np.cumsum(fresh) - 1, pc.binary_length(column).to_numpy() // 2)
        a, b = a[fresh], b[fresh]
        before, after = (
            np.bincount(word * width + x, minlength=len(a) * width).reshape(-1, width)
            for x in np.divmod(codes, width)
        )
        if kept is not None:
            if (kept[0][0], kept[1][0]) == (a[0], b[0]):
                before[0] += kept[2][0]
                after[0] += kept[3][0]
            else:
                yield out(*kept)
        kept = [x[-1:].copy() for x in (a, b, before, after)]
        if len(a) > 1:
            yield out(a[:-1], b[:-1], before[:-1], after[:-1])
    if kept is not None:
        yield out(*kept)


def _chains(batches, model):
    """Every text's states, and the words that were not looked up with their places."""
    m = model.value
    lookup, number = m["lookup"], 0
    base_part = TaskContext.get().partitionId() << 40
    for batch in batches:
        for low, high in texts.slices(batch.column(1), SLICE):
            a, b, rows = _words(batch.column(1).slice(low, high - low))
            at, found = lookup.find(a, b)
            some = len(lookup.a) > 0
            counts = np.where(found, m["n"][at] if some else 0, 0)
            states = np.where(found, lookup.number[at] if some else NOT_FOUND, NOT_FOUND)
            line = np.insert(states, rows[1:], CLASSES + 1).astype(np.uint8)
            n = len(rows) - 1
            bounds = (rows + np.arange(n + 1)).astype(np.int32)
            owner = np.repeat(np.arange(n), np.diff(rows))
            emitted = np.bincount(owner, np.where(found, m["emit"][at] if some else 0.0, 0.0), n)
            known = np.bincount(owner, counts > 0, n).astype(np.int64) + int(m["ends"] > 0)
            size = np.diff(rows) + 1
            base = np.bincount(owner, np.log10(counts + 1.0), n) + math.log10(m["ends"] + 1) + size * m["base"]
            # words that were not looked up, by text
            rest = np.flatnonzero(~found)
            order = rest[np.lexsort((b[rest], a[rest], owner[rest]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (
                (owner[order][1:] != owner[order][:-1]) | (a[order][1:] != a[order][:-1])
                | (b[order][1:] != b[order][:-1])
            )
            heads = np.flatnonzero(fresh)
            each = order[heads]
            places = pa.ListArray.from_arrays(
                pa.array(np.append(heads, len(order)).astype(np.int32)),
                pa.array((order - rows[owner[order]]).astype(np.int32)),
            )
            struct = pa.StructArray.from_arrays(
                [pa.array(a[each].view(np.int64)), pa.array(b[each].view(np.int64)), places],
                names=["a", "b", "places"],
            )
            ends = np.searchsorted(owner[each], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low),
                    pa.array(base_part + number + np.arange(n)), pa.array(size, pa.int64()),
                    pa.array(known), pa.array(base), pa.array(emitted),
                    pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(line)]),
                    pa.ListArray.from_arrays(pa.array(ends), struct),
                ],
                names=["id", "held_out", "row", "n_tokens", "n_known", "base_score", "score", "chain", "rest"],
            )
            number += n


def _filled(batches):
    """Rows: chain, fills, others. Gives the chain with the states of the fills; words not seen are other words."""
    for batch in batches:
        column, fills = batch.column(0), batch.column(1)
        sizes = pc.binary_length(column).to_numpy().astype(np.int64)
        ends = np.append(0, np.cumsum(sizes))
        line = np.frombuffer(b"".join(column.to_pylist()), np.uint8).copy()
        flat = fills.flatten()
        counts = pc.fill_null(pc.list_value_length(fills), 0).to_numpy(zero_copy_only=False)
        places, state = flat.field(0), flat.field(1).to_numpy(zero_copy_only=False)
        times = pc.list_value_length(places).to_numpy(zero_copy_only=False)
        at = places.flatten().to_numpy(zero_copy_only=False)
        line[at + np.repeat(np.repeat(ends[:-1], counts), times)] = np.repeat(state, times)
        left = line == NOT_FOUND
        unseen = np.add.reduceat(left, ends[:-1], dtype=np.int64) if len(sizes) else np.zeros(0, np.int64)
        line[left] = CLASSES
        yield pa.RecordBatch.from_arrays(
            [pa.BinaryArray.from_buffers(
                pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(line)]
            ), pa.array(unseen), *batch.columns[2:]],
            names=["chain", "unseen", *batch.schema.names[2:]],
        )


def _steps_of(column):
    """(state before, state) of all tokens, an end before each text, and where texts begin."""
    line = np.frombuffer(b"".join(column.to_pylist()), np.uint8).astype(np.int64)
    sizes = pc.binary_length(column).to_numpy().astype(np.int64)
    # every chain ends in an end
    return np.append(CLASSES + 1, line[:-1])[: len(line)], line, np.cumsum(sizes) - sizes


def _transitions(batches):
    out = np.zeros(STATES * STATES, np.int64)
    for batch in batches:
        before, line, _ = _steps_of(batch.column(0))
        out += np.bincount(before * STATES + line, minlength=STATES * STATES)
    at = np.flatnonzero(out)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], names=["pair", "n"])


def _stepped(batches, steps):
    """Rows: chain, score, others. Gives the score with the chain's steps."""
    for batch in batches:
        before, line, first = _steps_of(batch.column(0))
        sums = np.add.reduceat(steps.value[before, line], first) if len(first) else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(batch.column(1).to_numpy() + sums), *batch.columns[2:]], names=batch.schema.names[1:]
        )


def scores(docs: DataFrame, held_out: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, perplexity.

    ``held_out`` is SQL for rows that nothing is learned from; null counts as false. Words
    are what white space leaves of the text in lower case (A-Z); a null or empty text is one
    end. base_score adds one to every count; score is the class model's; both are log10 of
    the text's probability. perplexity is 10 ** (-score / n_tokens). Without training texts
    every base probability is one, and the classes are all alike. Repeated rows count and are
    scored each by itself; columns of ``docs`` beyond those named are not looked at.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col(id).alias("id"), F.col(text).alias("text"),
        F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"),
    )
    kind = source.schema["id"].dataType.simpleString()
    training = source.where("NOT held_out").select("text")
    counts = staged(
        training.mapInArrow(_count_words, "a long, b long, n long").groupBy("a", "b").agg(
            F.sum("n").alias("n")
        ),
        "counts",
    )
    ends = training.count()
    kinds, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, kinds = total + ends, kinds + int(ends > 0)

    top = counts.orderBy(F.desc("n"), "a", "b").limit(CLUSTERED).toArrow()
    size, context = len(top), spark.sparkContext
    clustered = context.broadcast(Lookup.of(top, np.arange(size)))
    pairs = training.mapInArrow(partial(_count_pairs, lookup=clustered), "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")
    ).selectExpr(f"cast(pair div {END + 1} AS int) AS v", f"cast(pair % {END + 1} AS int) AS w", "n")
    classes, table = _cluster(staged(pairs, "pairs"), size)

    around = training.mapInArrow(
        partial(_around, top=clustered, classes=context.broadcast(classes)), "a long, b long, around binary"
    )
    placed = around.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(
        partial(_placed, matrix=context.broadcast(table.tolist())), "a long, b long, n long, state int"
    )
    own = top.append_column("state", pa.array(classes[:size]))
    own = spark.createDataFrame(own.to_pylist(), "a long, b long, n long, state int")
    words = staged(own.union(placed), "words")

    in_class, kinds_in = np.zeros(STATES, np.int64), np.zeros(STATES, np.int64)
    for r in words.groupBy("state").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        in_class[r["state"]], kinds_in[r["state"]] = r["n"], r["kinds"]
    in_class[CLASSES] += kinds_in[CLASSES] + 1
    share = -np.log10(np.maximum(in_class[: CLASSES + 1], 1))

    grade = F.floor(F.log2("n") * 8)
    grades = words.groupBy(grade.alias("g")).agg(F.count("*").alias("words")).orderBy(F.desc("g")).collect()
    least, room = None, LOOKUP
    for r in grades:  # a few hundred
        if r["words"] > room:
            break
        least, room = r["g"], room - r["words"]
    known = words.where(grade >= least if least is not None else F.lit(False)).toArrow()
    lookup = Lookup.of(known, known["state"].to_numpy().astype(np.uint8))
    n = known["n"].to_numpy()[lookup.order]
    model = context.broadcast({
        "lookup": lookup, "n": n, "emit": np.log10(n + (lookup.number == CLASSES)) + share[lookup.number],
        "ends": ends, "base": -math.log10(total + kinds + 1),
    })
    scored = staged(
        source.select("id", "text", "held_out").mapInArrow(
            partial(_chains, model=model),
            f"id {kind}, held_out boolean, row long, n_tokens long, n_known long, base_score double, "
            "score double, chain binary, rest array<struct<a: long, b: long, places: array<int>>>",
        ),
        "scored",
    )
    rest = scored.select("row", F.explode("rest").alias("x")).selectExpr("row", "x.a", "x.b", "x.places")
    rare = (words.where(grade < least) if least is not None else words).withColumn(
        "emit",
        F.log10(F.col("n") + (F.col("state") == CLASSES).cast("int"))
        + F.element_at(F.array(*map(F.lit, share.tolist())), F.col("state") + 1),
    )
    added = rest.join(rare, ["a", "b"]).groupBy("row").agg(
        F.sum(F.size("places")).alias("known_more"),
        F.sum(F.size("places") * F.log10(F.col("n") + 1)).alias("more"),
        F.sum(F.size("places") * F.col("emit")).alias("emitted"),
        F.collect_list(F.struct("places", F.col("state").cast("int").alias("state"))).alias("fills"),  # of one text
    )
    found = scored.drop("rest").join(added, "row", "left").select(
        "chain", "fills", "id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known_more", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("emitted", F.lit(0.0))).alias("score"),
    )
    others = f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double"
    whole = staged(found.mapInArrow(_filled, f"chain binary, unseen long, {others}, score double"), "chains")

    table = np.zeros(STATES * STATES, np.int64)
    for r in whole.where("NOT held_out").select("chain").mapInArrow(_transitions, "pair long, n long").groupBy(
        "pair"
    ).agg(F.sum("n").alias("n")).collect():  # at most STATES * STATES
        table[r["pair"]] = r["n"]
    table = table.reshape(STATES, STATES)
    steps = np.log10((table + SMOOTHING) / (table.sum(1, keepdims=True) + SMOOTHING * STATES))
    names = ["id", "held_out", "n_tokens", "n_known", "base_score"]
    score = F.col("score") + F.col("unseen") * F.lit(float(share[CLASSES]))
    return whole.select("chain", score.alias("score"), *names).mapInArrow(
        partial(_stepped, steps=context.broadcast(steps)), f"score double, {others}"
    ).select(
        F.col("id").alias(id), "held_out", "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
