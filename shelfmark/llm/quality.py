"""Quality rules by robust multivariate outliers, in DataFrame operations only.

Every text gives a vector of transformed statistics. For each language and source (of too
few documents: for the language, then for all documents) a minimum covariance determinant
estimate is made in the deterministic way: two starts (the
quartiles of each coordinate, and the plain mean and covariance), then concentration steps,
each keeping the half to three quarters of the documents nearest by the last estimate; of the
two, the one with the least determinant stays. Documents whose Mahalanobis distance from it
is beyond a cutoff are rejected.

Coordinates are whole numbers (steps of 1 / ``SCALE``), so sums are exact and results do not
depend on how rows are spread. Distances fall into bins of 1 / ``FINE``; one aggregation
by group and bin, of counts and sums, gives a step its subset and its next estimate at
once. A group of any size is a few thousand bins.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.tables import staged

SCALE = 256
#: Share of the documents that an estimate rests on, and steps from each start.
KEEP = 0.75
STEPS = 3
FINE = 16
LAST_BIN = 4000
#: Least standard deviation of each coordinate, which keeps covariances regular.
FLOORS = (0.25, 0.06, 0.06, 0.15, 0.6)
#: The median of a chi-square variable with five degrees of freedom.
MEDIAN_SQUARE = 4.351460191095526
#: Squared distance, scaled to that median, beyond which a document is rejected.
CUTOFF = 250.0
#: Documents of a language and source with fewer to estimate from are judged by their language's
#: estimate, those of a language with fewer by the estimate of all documents, however few.
LEAST_GROUP = 30
P = len(FLOORS)
COORDINATES = [f"q{i}" for i in range(P)]
PRODUCTS = [(i, j) for i in range(P) for j in range(i + 1)]

RESULT = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "square",
    "kept",
)

_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words in runs of three that occur twice or more. Runs are compared by 64-bit hashes."""

    def covered(runs: Column) -> Column:
        ordered = F.sort_array(
            F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def repeated(s: Column) -> Column:
            marked = F.transform(
                s, lambda x, i: F.when(
                    (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"]
                )
            )
            return F.sort_array(F.array_compact(marked))

        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        total = F.aggregate(
            _let(ordered, repeated), start,
            lambda a, i: F.struct(
                (a["n"] + (i + 3 - F.greatest(a["end"], i))).cast("long").alias("n"),
                (i + 3).alias("end"),
            ),
        )
        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0).cast("long")).otherwise(total["n"])

    def counted(w: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)),
        )
        return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(_let(runs, covered))

    return _let(words, counted)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and base_failed."""
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(value, _SPACE), lambda w: w != "")
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def removed(drop: str) -> Column:
        return F.length(F.translate(value, drop, "")).cast("long")

    both = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")
    ))
    return docs.select(
        *[c for c in docs.columns if c != text],
        both.alias("_w"), removed(" \t\n\x0b\x0c\r").alias("word_chars"),
        (F.length(value) - removed("#*$%&|<>")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select(
        "*", F.col("_w.n_words").alias("n_words"), F.col("_w.n_repeat_words").alias("n_repeat_words")
    ).drop("_w").withColumn(
        "base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    )


def _vector(stats: DataFrame) -> DataFrame:
    values = (
        "ln(n_words)", "ln(word_chars / n_words)", "sqrt(n_symbols / word_chars)",
        "sqrt(n_repeat_words / n_words)", "ln(1 + n_dup_lines)",
    )
    return stats.withColumns({
        q: F.expr(f"CASE WHEN NOT base_failed THEN cast(floor({v} * {SCALE} + 0.5) AS long) END")
        for q, v in zip(COORDINATES, values)
    })


def _solved(sums: DataFrame) -> DataFrame:
    """Means, the inverse of the covariance's unit lower factor, its diagonal, its log
    determinant, from a count, sums and sums of products."""
    means = {f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(P)}
    out = sums.withColumns(means)
    floor = [(f * SCALE) ** 2 for f in FLOORS]
    out = out.withColumns({
        f"c{i}{j}": F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
        + (floor[i] if i == j else 0.0)
        for i, j in PRODUCTS
    })
    return _factored(out)


def _factored(out: DataFrame) -> DataFrame:
    for j in range(P):
        d = F.col(f"c{j}{j}")
        for k in range(j):
            d = d - F.col(f"l{j}{k}") * F.col(f"l{j}{k}") * F.col(f"d{k}")
        out = out.withColumn(f"d{j}", d)
        for i in range(j + 1, P):
            c = F.col(f"c{i}{j}")
            for k in range(j):
                c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}") * F.col(f"d{k}")
            out = out.withColumn(f"l{i}{j}", c / F.col(f"d{j}"))
    for i in range(P):
        for j in reversed(range(i)):
            w = -F.col(f"l{i}{j}")
            for k in range(j + 1, i):
                w = w - F.col(f"l{i}{k}") * F.col(f"w{k}{j}")
            out = out.withColumn(f"w{i}{j}", w)
    logdet = sum((F.log(f"d{j}") for j in range(1, P)), F.log("d0"))
    return out.withColumn("logdet", logdet).select(*_KEYS, *_ESTIMATE)


#: What an estimate is of; level 0: a language and source, 1: a language, 2: all documents.
_GROUP = ["level", "g_lang", "g_source"]
_KEYS = [*_GROUP, "start"]
_ESTIMATE = (
    [f"m{i}" for i in range(P)] + [f"d{i}" for i in range(P)]
    + [f"w{i}{j}" for i in range(P) for j in range(i)] + ["logdet"]
)
_SUMS = ["n", *[f"s{i}" for i in range(P)], *[f"s{i}{j}" for i, j in PRODUCTS]]


def _square() -> Column:
    """Squared distance of the row's vector from its group's estimate."""
    total = None
    for i in range(P):
        z = F.col(f"q{i}") - F.col(f"m{i}")
        for j in range(i):
            z = z + F.col(f"w{i}{j}") * (F.col(f"q{j}") - F.col(f"m{j}"))
        part = z * z / F.col(f"d{i}")
        total = part if total is None else total + part
    return total


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(f"q{i}").alias(f"s{i}") for i in range(P)],
        *[F.sum(F.col(f"q{i}") * F.col(f"q{j}")).alias(f"s{i}{j}") for i, j in PRODUCTS],
    )


def _near(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by group; a null language or source is a group."""
    keys = [k for k in _GROUP if k in right.columns]
    right = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys])
    return left.join(right, on, how).drop(*[f"r_{k}" for k in keys])


def _of_level(level: Column, rows: DataFrame) -> DataFrame:
    """``rows`` with the group that they have at ``level``."""
    return rows.withColumn("level", level).withColumns({
        "g_lang": F.when(F.col("level") < 2, F.col("g_lang")),
        "g_source": F.when(F.col("level") < 1, F.col("g_source")),
    })


def _levels(rows: DataFrame) -> DataFrame:
    """For each language and source: own, the level that judges its documents, and levels,
    those whose estimates rest on them."""
    sizes = staged(rows.groupBy("g_lang", "g_source").agg(F.count("*").alias("n")), "sizes")
    langs = sizes.groupBy("g_lang").agg(F.sum("n").alias("lang_n"), F.min("n").alias("least"))
    few = langs.where(f"lang_n < {LEAST_GROUP}").limit(1).count() > 0
    return staged(_near(sizes, langs).select(
        "g_lang", "g_source",
        F.expr(f"CASE WHEN n >= {LEAST_GROUP} THEN 0 WHEN lang_n >= {LEAST_GROUP} THEN 1 ELSE 2 END").alias("own"),
        F.array_compact(F.array(
            F.expr(f"CASE WHEN n >= {LEAST_GROUP} THEN 0 END"),
            F.expr(f"CASE WHEN lang_n >= {LEAST_GROUP} AND least < {LEAST_GROUP} THEN 1 END"),
            F.when(F.lit(few), F.lit(2)),
        )).alias("levels"),
    ), "levels")


def _starts(rows: DataFrame) -> DataFrame:
    """Two estimates for each group."""
    sums = staged(_summed(rows, *_GROUP), "sums")
    plain = _solved(sums.withColumn("start", F.lit(2)))
    flat = ", ".join(f"{i}, q{i}" for i in range(P))
    counts = rows.selectExpr(*_GROUP, f"stack({P}, {flat}) AS (i, q)").groupBy(
        *_GROUP, "i", "q"
    ).agg(F.count("*").alias("n"))
    group = Window.partitionBy(*_GROUP, "i")
    counts = counts.withColumn("upto", F.sum("n").over(group.orderBy("q"))).withColumn(
        "all", F.sum("n").over(group)
    )
    quartiles = counts.groupBy(*_GROUP, "i").agg(*[
        F.min(F.when(F.expr(f"4 * upto >= {k} * all"), F.col("q"))).alias(f"at{k}") for k in (1, 2, 3)
    ])
    wide = quartiles.groupBy(*_GROUP).agg(*[
        F.max(F.when(F.col("i") == i, F.col(f"at{k}"))).alias(f"at{k}_{i}")
        for i in range(P) for k in (1, 2, 3)
    ])
    robust = _near(sums.select(*_GROUP), wide).withColumn("start", F.lit(1))
    for i, j in PRODUCTS:
        spread = (F.col(f"at3_{i}") - F.col(f"at1_{i}")) / F.lit(1.349)
        robust = robust.withColumn(
            f"c{i}{j}", spread * spread + (FLOORS[i] * SCALE) ** 2 if i == j else F.lit(0.0)
        )
    robust = robust.withColumns({f"m{i}": F.col(f"at2_{i}").cast("double") for i in range(P)})
    return staged(plain.unionByName(_factored(robust)), "estimate")


def _binned(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    at = F.least(F.lit(LAST_BIN), F.floor(F.sqrt(_square()) * FINE).cast("int"))
    return _near(rows, estimate).withColumn("bin", at)


def _step(rows: DataFrame, estimate: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The next estimate, and the median bin by the last one."""
    bins = staged(_summed(_binned(rows, estimate), *_KEYS, "bin"), "bins")
    group = Window.partitionBy(*_KEYS)
    bins = bins.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn(
        "all", F.sum("n").over(group)
    )
    half = bins.groupBy(*_KEYS).agg(F.min(F.expr("CASE WHEN 2 * upto >= all THEN bin END")).alias("median"))
    kept = bins.where(f"upto - n < {KEEP} * all").groupBy(*_KEYS).agg(
        *[F.sum(c).alias(c) for c in _SUMS]
    )
    return staged(_solved(kept), "estimate"), half


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` without the text, with the statistics of ``statistics``, base_failed,
    square (scaled squared distance; null if base_failed) and kept.

    Words are what white space leaves of the text; a null text has none and fails. kept is
    false if base_failed (under 50 words, or more than half of them in repeated runs of
    three), else unless square is beyond CUTOFF. A null language or source is a group like
    others; documents of groups with fewer than LEAST_GROUP to estimate from are judged by their
    language's estimate, or that of all documents. Columns of ``docs`` named as results are
    replaced. Rows that are alike are judged alike, each by itself.
    """
    clash = {c: f"in_{i}" for i, c in enumerate(docs.columns) if c not in (text, lang, source)}
    stats = docs.withColumnsRenamed(clash).withColumnsRenamed({lang: "g_lang", source: "g_source", text: "_text"})
    rows = staged(_vector(statistics(stats, "_text")), "statistics")
    usable = rows.where("NOT base_failed").select("g_lang", "g_source", *COORDINATES)
    levels = _levels(usable)
    usable = staged(
        _of_level(F.explode("levels"), _near(usable, levels)).select(*_GROUP, *COORDINATES), "members"
    )
    estimate = _starts(usable)
    for _ in range(STEPS):
        estimate, _half = _step(usable, estimate)
    best = estimate.groupBy(*_GROUP).agg(
        F.min(F.struct("logdet", "start", *[c for c in _ESTIMATE if c != "logdet"])).alias("b")
    ).select(*_GROUP, "b.*")
    best = staged(best, "best")
    _, half = _step(usable, best)
    best = staged(_near(best, half.drop("start")), "scaled")
    width = (F.col("median") + 1) / F.lit(float(FINE))
    square = _square() * MEDIAN_SQUARE / (width * width)
    # the columns of the language and source stay as they are
    placed = _of_level(F.col("own"), _near(rows, levels, "left").withColumns({"_lang": F.col("g_lang"), "_source": F.col("g_source")}))
    found = _near(placed, best, "left").withColumn("square", F.when(~F.col("base_failed"), square))
    found = found.drop("g_lang", "g_source").withColumnsRenamed({"_lang": "g_lang", "_source": "g_source"})
    names = {v: k for k, v in clash.items()} | {"g_lang": lang, "g_source": source}
    return found.select(
        *[F.col(c).alias(names[c]) for c in stats.columns if c in names and names[c] not in RESULT],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "square",
        (~F.col("base_failed") & (F.col("square").isNull() | (F.col("square") <= CUTOFF))).alias("kept"),
    )
