"""Collections of passages, one per corpus, that follow the catalog.

A collection is stored in slots, by a hash of the path, so a book that comes, goes or changes
its corpus has its slots rewritten and nothing else. There is no record of what was done:
what the stored passages hold is compared with what the catalog wants. So a run that died
between two slots is made good by the next. One run writes at a time.
"""

from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.chapters import HEADING, chapter_chunks
from shelfmark.sources.folders import names_in, remove
from shelfmark.sources.staging import staging_dir, written

#: Slots of a corpus; choose them so that one holds about a gigabyte.
SLOTS = 256
CITED = ["path", "sha256", "corpus", "author", "book"]
SCHEMA = (
    "path string, sha256 string, author string, book string, chapter_no int, chapter string,"
    " chunk_no int, location long, chunk string, corpus string, slot int"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
PLACE = ["path", "corpus", "slot"]


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """All passages of the collections in a folder; none where it does not exist."""
    if not names_in(spark, folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(folder)


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per path whose holdings (``before``: path, sha256, corpus, author, book, slot) are not
    what is wanted (``after``: the same but slot, a path once): path, op, from_corpus, to_corpus, and
    held, source and wanted for ``sync``.

    op: insert, delete, change (other content; a content without a hash always counts as that), move (to another
    corpus), retitle (other author or book), or repeated (held in several places, one of them right).
    Rows without a path or corpus are not looked at. A path has few holdings: one per corpus at most.
    """
    known = "path IS NOT NULL AND corpus IS NOT NULL"
    old = before.where(known).groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("corpus", "slot", "sha256", "author", "book"))).alias("held")
    )
    new = after.where(known).select("path", F.struct("sha256", "corpus", "author", "book").alias("wanted"))
    alike = "coalesce(x.sha256 = wanted.sha256, false)"
    exact = f"{alike} AND x.corpus = wanted.corpus AND x.author <=> wanted.author AND x.book <=> wanted.book"
    found = old.join(new, "path", "full").withColumns({
        "exact": F.expr(f"get(filter(held, x -> {exact}), 0)"),
        "alike": F.expr(f"coalesce(get(filter(held, x -> {alike} AND x.corpus = wanted.corpus), 0),"
                        f" get(filter(held, x -> {alike}), 0))"),
    })
    op = """CASE WHEN held IS NULL THEN 'insert' WHEN wanted IS NULL THEN 'delete'
        WHEN exact IS NOT NULL THEN if(size(held) = 1, 'same', 'repeated') WHEN alike IS NULL THEN 'change'
        WHEN alike.corpus <> wanted.corpus THEN 'move' ELSE 'retitle' END"""
    return found.selectExpr(
        "path", f"{op} AS op", "coalesce(exact, alike, held[0]).corpus AS from_corpus",
        "wanted.corpus AS to_corpus", "held", "coalesce(exact, alike) AS source", "wanted",
    ).where("op <> 'same'")


def _slot(slots: int) -> str:
    return f"int(pmod(xxhash64(path), {slots}))"


def _in(places) -> F.Column:
    """Whether a row lies in one of the (corpus, slot): a filter on partitions."""
    corpora = {}
    for corpus, slot in places:
        corpora.setdefault(corpus, []).append(slot)
    each = [(F.col("corpus") == c) & F.col("slot").isin(sorted(s)) for c, s in sorted(corpora.items())]
    return reduce(or_, each, F.lit(False))


def _places(df: DataFrame) -> set:
    """(corpus, slot) of the rows: at most the corpora times their slots."""
    return {tuple(r) for r in df.select("corpus", "slot").distinct().collect()}


def sync(folder: str, wanted: DataFrame, texts: DataFrame, work: str, heading: str = HEADING,
         slots: int = SLOTS) -> DataFrame:
    """Bring the collections in ``folder`` to ``wanted`` (path, sha256, corpus, author, book; see
    ``curation.citable``), and give the changes made (path, op, from_corpus, to_corpus).

    ``texts`` (path, text) is read for inserted and changed books only; a book that moves or is
    retitled takes its stored passages along, so another ``heading`` shows in books cut anew. Books
    without text hold nothing, and are inserts each time that rewrite nothing.
    """
    spark = wanted.sparkSession
    place, slot = staging_dir(spark, work), _slot(slots)
    passages = stored(spark, folder)
    books = written(
        passages.where("chapter_no = 0 AND chunk_no = 0").select(*CITED, "slot"), f"{place}/books"
    )
    feed = written(changes(books, wanted.select(CITED)), f"{place}/changes")

    cut = feed.where("op IN ('insert', 'change')").select("path", "wanted.*")
    fresh = chapter_chunks(cut.join(texts.select("path", "text"), "path"), heading=heading)
    fresh = written(fresh.withColumn("slot", F.expr(slot)).select(COLUMNS), f"{place}/fresh")
    # what becomes of each holding: it goes, or goes on as ``goes_to``
    here = "held.corpus = source.corpus AND held.slot = source.slot"
    fates = feed.withColumn("held", F.explode("held")).where(f"NOT (op = 'repeated' AND {here})").selectExpr(
        "path", "held.corpus", "held.slot", f"if(op IN ('move', 'retitle') AND {here}, wanted, NULL) AS goes_to"
    )
    arriving = fates.where("goes_to IS NOT NULL").selectExpr("path", "goes_to.corpus", f"{slot} AS slot")
    filled = _places(fresh) | _places(arriving)
    left = _places(fates)
    touched = filled | left
    if not touched:
        return feed.select("path", "op", "from_corpus", "to_corpus")
    staying = books.where(_in(touched)).join(fates, PLACE, "left_anti")
    emptied = left - filled - _places(staying)

    old = passages.where(_in(touched)).join(fates.withColumn("leaves", F.lit(True)), PLACE, "left")
    old = old.where("leaves IS NULL OR goes_to IS NOT NULL").withColumns({
        "corpus": F.expr("if(leaves, goes_to.corpus, corpus)"), "slot": F.expr(f"if(leaves, {slot}, slot)"),
        "author": F.expr("if(leaves, goes_to.author, author)"), "book": F.expr("if(leaves, goes_to.book, book)"),
    })
    # a slot is one file of one task, so it is there in full or not at all
    result = old.select(COLUMNS).union(fresh).repartition("corpus", "slot")
    result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "corpus", "slot"
    ).parquet(folder)
    if emptied:
        named = {unquote(n): n for n in names_in(spark, folder)}
        for corpus, number in sorted(emptied):
            remove(spark, f"{folder}/{named[f'corpus={corpus}']}/slot={number}")
    return feed.select("path", "op", "from_corpus", "to_corpus")
