"""MinHash near-duplicates: an inverted join on signature coordinates.

Every distinct shingle set gets a signature of ``COORDINATES`` minima. A (coordinate,
value) pair is a token; documents of similarity s share about s * COORDINATES tokens. Two
that share ``MATCHES`` or more must share one of each other's rarest
COORDINATES - MATCHES + 1 tokens (prefix), so documents are posted under those only, and
tokens that one document alone holds are never posted. Collisions of postings give
candidates; their whole signatures are counted only where sizes allow the similarity
(skip), and pairs with at least ``MATCHES`` are confirmed on their full sets. At a
similarity of 0.8 a pair misses ``MATCHES`` with a probability below one in a million.

Pairs in a large group are not listed. Shingles that no other posted set holds are counted,
so s, the number of a set's other shingles, bounds all its intersections, and pairs whose
bound is too small are skipped. First every member meets the member of its posting list with
the smallest share of shingles of its own. Then only members that are still outside the list's main component meet
the others, and only across components, so what is linked already is not compared again
while no link between two components is lost. A set outside that is to have a of its n shingles
in common with another one has at least one of any n - a + 1 in common: it meets those others
only, of the main component and of the sets outside, that hold one of its rarest among them.
Texts of a pair are compared only if sketches of the sets, which never differ by more bits than
the sets by shingles, leave the similarity open.
"""

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import texts
from shelfmark.llm.components import components
from shelfmark.llm.tables import small, staged

COORDINATES = 48
MATCHES = 24
#: Bits of a set's sketch.
BITS = 4096
SIMILARITY = 80  # percent
#: Sizes of sets in one class differ by a hundredth.
_SIZE_CLASS = "cast(floor(100 * ln(n)) AS int)"
_FACTORS = np.random.Generator(np.random.PCG64(48)).integers(
    1, 1 << 63, COORDINATES, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """32 bits each of the coordinates' minima, as signed numbers. Minima lie close together,
    so they are mixed first: else unlike ones of many sets would share their upper halves."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        np.minimum(least, (_FACTORS[:, None] * shingles[None, i : i + 4096]).min(1), out=least)
    return (texts.mix(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sets(column: pa.Array, size: int):
    """The sorted distinct shingle hashes of each row, slice by slice."""
    for first, last in texts.slices(column):
        words, rows = texts.word_hashes(column.slice(first, last - first), texts.SPACES)
        for low, high in zip(rows[:-1], rows[1:]):
            yield texts.distinct(texts.shingles(words[low:high], size))


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures(batches, size: int):
    for batch in batches:
        counts, keys, signs = [], [], []
        for s in _sets(batch.column(1), size):
            counts.append(len(s))
            keys.append(_key(s) if len(s) else None)
            signs.append(signature(s) if len(s) else np.zeros(COORDINATES, np.int32))
        flat = np.concatenate(signs) if signs else np.zeros(0, np.int32)
        offsets = np.arange(len(signs) + 1, dtype=np.int32) * COORDINATES
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            ],
            names=["id", "n_shingles", "key", "sign"],
        )


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """BITS bits, each of which every shingle that falls on it turns over. So two sets' sketches
    differ in at most as many bits as there are shingles that one of them holds alone."""
    bits = np.bincount((texts.mix(shingles) >> np.uint64(32)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _keyed(batches, size: int):
    for batch in batches:
        keys, sketches = [], []
        for s in _sets(batch.column(1), size):
            keys.append(_key(s) if len(s) else None)
            sketches.append(_sketch(s))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), batch.column(1), pa.array(sketches, pa.list_(pa.int64()))],
            names=["key", "text", "sketch"],
        )


def _exploded(batches, size: int):
    for batch in batches:
        for low, high in texts.slices(batch.column(1)):
            found = list(_sets(batch.column(1).slice(low, high - low), size))
            owner = np.repeat(np.arange(low, high), [len(s) for s in found])
            flat = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(flat)], names=["key", "shingle"]
            )


def _confirmed(batches, size: int, similarity: int):
    """Pairs whose full sets are similar enough. Rows: a, text of a, b, text of b."""
    held: tuple = (None, None)
    for batch in batches:
        keep = []
        for a, x, b, y in zip(*(c.to_pylist() for c in batch.columns)):
            if held[0] != a:
                held = a, next(_sets(pa.array([x]), size))
            other = next(_sets(pa.array([y]), size))
            common = len(np.intersect1d(held[1], other, assume_unique=True))
            union = len(held[1]) + len(other) - common
            keep.append(100 * common >= similarity * union)
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(mask), batch.column(2).filter(mask)], names=["a", "b"]
        )


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text",
    shingle: int = 5, similarity: int = SIMILARITY,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept, set_key.

    Words are what white space leaves of the text in lower case (A-Z). A document's set
    holds its distinct runs of ``shingle`` words, or its one shorter run; two documents are
    linked if 100 * intersection >= similarity * union. component_id is the smallest id
    that can be reached, kept tells whether that is the row's own. A document without words
    or text is linked with nothing and kept. Rows with the same id keep their own rows and
    sets, rows with equal sets are one group whatever their ids, and a null id is never
    smallest and always kept. Other columns of ``docs`` are not looked at.
    """
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = staged(
        source.mapInArrow(
            partial(_signatures, size=shingle),
            f"id {kind}, n_shingles long, key binary, sign array<int>",
        ),
        "signatures",
    )
    classes = staged(
        signed.where("key IS NOT NULL").groupBy("key").agg(
            F.min("id").alias("first"), F.first("n_shingles").alias("n"),
            F.first("sign").alias("sign"),
        ),
        "classes",
    )
    postings = _postings(classes)
    sets = _texts(source, postings, classes, shingle)
    alone = sets.mapInArrow(partial(_exploded, size=shingle), "key binary, shingle long").groupBy(
        "shingle"
    ).agg(F.count("*").alias("held"), F.min("key").alias("key")).where("held = 1").groupBy("key").agg(
        F.count("*").alias("alone")
    )
    postings = staged(
        postings.join(alone, "key", "left").selectExpr("token", "key", "n", "n - coalesce(alone, 0) AS s"),
        "postings",
    )
    likely = partial(_likely, sets=sets, similarity=similarity)
    confirm = partial(_links, sets=sets, size=shingle, similarity=similarity)

    most = "least(s, other_s)"  # no intersection is larger
    fits = f"100 * {most} >= {similarity} * (n + other_n - {most})"
    heads = postings.groupBy("token").agg(
        F.min(F.struct(F.expr("(n - s) / n").alias("share"), "key", "n", "s")).alias("head"),
        F.count("*").alias("members"),
    ).where("members > 1").selectExpr(
        "token", "head.key AS other", "head.n AS other_n", "head.s AS other_s"
    )
    first = postings.join(heads.repartition("token"), "token").where(f"key <> other AND {fits}")
    links = confirm(likely(_close(first, classes)))

    roots = components(links).withColumnRenamed("node", "key")
    placed = staged(
        postings.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "placed"
    )
    main = placed.groupBy("token", "root").agg(
        F.count("*").alias("members"), F.min("n").alias("least")
    ).groupBy("token").agg(
        F.max_by("root", F.struct("members", "root")).alias("main"), F.count("*").alias("roots"),
        F.min("least").alias("least"),
    ).where("roots > 1").select("token", "main", "least")
    outside = staged(
        placed.join(main.repartition("token"), "token").where(
            f"root <> main AND 100 * s >= {similarity} * (n + least - s)"
        ),
        "outside",
    )
    nodes = placed.select("key", "n", "s", "root").distinct()
    second = _across(outside, nodes, sets, shingle, similarity).join(nodes, "key").join(
        nodes.selectExpr("key AS other", "n AS other_n", "s AS other_s", "root AS other_root"), "other"
    ).where(f"root <> other_root AND {fits}")
    second = staged(likely(_close(second, classes)).join(
        nodes.selectExpr("key AS a", "root AS root_a"), "a"
    ).join(nodes.selectExpr("key AS b", "root AS root_b"), "b").selectExpr(
        "a", "b", "apart", "least(root_a, root_b) AS low", "greatest(root_a, root_b) AS high"
    ), "second")
    # of two components the pair that is least apart; where it is no link, all of them
    best = staged(second.groupBy("low", "high").agg(F.min(F.struct("apart", "a", "b")).alias("pair")).select(
        "low", "high", "pair.a", "pair.b"
    ), "best")
    found = confirm(best)
    left = best.join(found, ["a", "b"], "left_anti").select("low", "high")
    rest = second.join(left, ["low", "high"], "left_semi").join(best, ["a", "b"], "left_anti")
    links = links.unionByName(found).unionByName(confirm(rest))

    roots = components(links).withColumnRenamed("node", "key")
    placed = classes.select("key", "first").join(roots, "key", "left").withColumn(
        "root", F.coalesce("root", "key")
    )
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = placed.join(least, "root").selectExpr("key", "component_id")
    found = signed.select("id", "n_shingles", "key").join(groups, "key", "left")
    return found.select(
        F.col("id").alias(id), "n_shingles",
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id"),
        F.coalesce(F.expr("key IS NULL OR id = component_id"), F.lit(True)).alias("kept"),
        F.col("key").alias("set_key"),
    )


def _across(outside: DataFrame, nodes: DataFrame, sets: DataFrame, size: int, similarity: int) -> DataFrame:
    """(key, other): sets outside a component, and the members of it and other sets outside that
    may be similar enough, each with at least one of the set's rarest shingles in common.

    Shingles are counted per component and class of sizes, so that the least intersection is
    close to that of the pair."""
    mains = outside.select("main").distinct()
    members = nodes.withColumnRenamed("root", "main").join(mains.repartition("main"), "main").select(
        "key", "main", "n", F.lit(False).alias("out")
    ).unionByName(outside.select("key", "main", "n", F.lit(True).alias("out")).distinct())
    rows = sets.join(members, "key").select(F.struct("key", "main", "n", "out").alias("key"), "text")
    held = staged(
        rows.mapInArrow(
            partial(_exploded, size=size),
            "key struct<key: binary, main: binary, n: long, out: boolean>, shingle long",
        ).selectExpr("key.*", "shingle", f"{_SIZE_CLASS} AS class"),
        "held",
    )
    counts = held.groupBy("main", "shingle", "class").agg(F.count("*").alias("held"))
    low, high = "floor(exp(class / 100))", "ceil(exp((class + 1) / 100))"
    # a set outside is among those counted
    common = held.where("out").withColumnRenamed("class", "own").join(
        counts.repartition("main", "shingle"), ["main", "shingle"]
    ).withColumn("held", F.expr("if(class = own, held - 1, held)")).where(
        f"held > 0 AND 100 * {high} >= {similarity} * n AND 100 * n >= {similarity} * {low}"
    ).groupBy("key", "main", "n", "class").agg(
        F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("common")  # of one set
    )
    # the rarest, of which one is in common with a set of this size
    more = f"size(common) - greatest(ceil({similarity} * n / 100), ceil({similarity} * (n + {{}}) / {100 + similarity}))"
    rarest = common.withColumn("more", F.expr(f"cast({more.format(low)} AS int)")).where("more >= 0").select(
        "key", "main", "class", "n", F.size("common").alias("size"),
        F.posexplode(F.expr("slice(common, 1, more + 1)")).alias("place", "c"),
    ).select("key", "main", "class", "n", "size", "place", "c.shingle")
    others = held.selectExpr("main", "class", "shingle", "key AS other", "n AS other_n")
    return rarest.join(others, ["main", "class", "shingle"]).where(
        f"key <> other AND place <= {more.replace('size(common)', 'size').format('other_n')}"
    ).select("key", "other").distinct()


def _matches(a: str, b: str) -> str:
    return f"size(filter(zip_with({a}, {b}, (x, y) -> x = y), x -> x))"


def _postings(classes: DataFrame) -> DataFrame:
    """(token, key, n): each set under those of its rarest tokens that others hold too."""
    tokens = classes.select("key", "n", F.posexplode("sign").alias("i", "v")).selectExpr(
        "key", "n", "shiftleft(cast(i AS long), 32) | (v & 4294967295L) AS token"
    )
    shared = tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    listed = tokens.join(shared.repartition("token"), "token").groupBy("key", "n").agg(
        F.sort_array(F.collect_list(F.struct("held", "token"))).alias("listed")  # <= COORDINATES
    ).where(F.size("listed") >= MATCHES)
    # tokens held by no other set are rarer than all these and fill the prefix first
    prefix = F.expr(f"slice(listed, 1, size(listed) - {MATCHES - 1})")
    return staged(
        listed.select("key", "n", F.explode(prefix).alias("p")).selectExpr("p.token", "key", "n"),
        "postings",
    )


def _texts(source: DataFrame, postings: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(key, text, sketch) of one document for each posted set."""
    posted = postings.select("key").distinct()
    wanted = staged(classes.join(posted, "key", "left_semi").selectExpr("first AS id"), "wanted")
    wanted = small(wanted.distinct())
    found = source.join(wanted, "id", "left_semi").select("id", "text")
    keyed = found.mapInArrow(partial(_keyed, size=size), "key binary, text string, sketch array<long>")
    return staged(keyed.where("key IS NOT NULL").dropDuplicates(["key"]), "sets")


def _close(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of the candidates (key, other) with enough matches of their whole signatures."""
    pairs = found.selectExpr("least(key, other) AS a", "greatest(key, other) AS b")
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("collisions"))
    one = classes.selectExpr("key AS a", "sign AS sign_a", "n AS n_a")
    two = classes.selectExpr("key AS b", "sign AS sign_b", "n AS n_b")
    return pairs.join(one, "a").join(two, "b").where(
        f"{_matches('sign_a', 'sign_b')} >= {MATCHES}"
    ).select("a", "b", "n_a", "n_b")


def _likely(close: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(a, b, apart): the pairs whose sketches do not tell apart the sets by more shingles than
    the similarity allows."""
    apart = "aggregate(zip_with(sketch_a, sketch_b, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y)"
    return close.join(sets.selectExpr("key AS a", "sketch AS sketch_a"), "a").join(
        sets.selectExpr("key AS b", "sketch AS sketch_b"), "b"
    ).withColumn("apart", F.expr(apart)).where(
        f"100 * (n_a + n_b - apart) >= {similarity} * (n_a + n_b + apart)"
    ).select("a", "b", "apart")


def _links(close: DataFrame, sets: DataFrame, size: int, similarity: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    close = staged(close.select("a", "b"), "close")
    texts_of = close.join(sets.selectExpr("key AS a", "text AS text_a"), "a").join(
        sets.selectExpr("key AS b", "text AS text_b"), "b"
    )
    found = texts_of.select("a", "text_a", "b", "text_b").mapInArrow(
        partial(_confirmed, size=size, similarity=similarity), "a binary, b binary"
    )
    return staged(found, "links")
