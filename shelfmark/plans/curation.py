"""Queries on what follows a scan, over the stored snapshot after it.

Document titles stand in ``documents`` as source and length ("src3 - Étude No. 12"), so copies
and other formats of a title occur; assignments, conversions and embeddings follow ``labels``.
Corpora are assigned first: copies, titles, layout, passages and searches go by them.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.isbn import isbn13
from shelfmark.operators import collections, curation, moves, near_titles, passages, reconcile, retrieval
from shelfmark.plans.queries import _contents, _files, _stored
from shelfmark.sources import conversions, tables
from shelfmark.sources.staging import staging_dir, unsent, written

LIBRARY = "/library"
#: The documents' headings: lines of up to 24 characters.
SHORT_LINE = r"\S[^\n]{0,23}"


def _documents(spark, sf_dir) -> DataFrame:
    return tables.table(spark, sf_dir, "documents").withColumn(
        "path", F.expr(tables.FILES_OF["documents"][1])
    )


def _titled(spark, sf_dir) -> DataFrame:
    named = _documents(spark, sf_dir).selectExpr(
        "path", "concat(source, ' - Étude No. ', n_chars div 100) AS name"
    )
    return curation.titled(_assigned(spark, sf_dir), named)


def _decided(spark, sf_dir) -> DataFrame:
    def build(spark, sf_dir):
        return curation.decided(curation.with_keeper(_titled(spark, sf_dir)))

    return _stored(spark, sf_dir, "decided", build)


def _labelled(spark, sf_dir) -> DataFrame:
    """(number, new_sha256, quality, toxic) of labelled documents."""
    labels = tables.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "number")
    return _contents(spark, sf_dir).where("kind = 'documents'").join(unsent(labels), "number")


def _assigned(spark, sf_dir) -> DataFrame:
    given = _labelled(spark, sf_dir).selectExpr(
        "new_sha256 AS sha256",
        """CASE WHEN quality = 0 THEN 'untrusted-nonfiction' WHEN toxic = 1 THEN 'fiction'
           WHEN toxic = 0 THEN 'trusted-nonfiction' END AS corpus""",
    )
    return curation.assigned(_files(spark, sf_dir), given)


def _layout(spark, sf_dir) -> DataFrame:
    return curation.layout(_decided(spark, sf_dir), LIBRARY)


def _moves(spark, sf_dir) -> DataFrame:
    return curation.manifest(_layout(spark, sf_dir), LIBRARY)


def _chunks(spark, sf_dir) -> DataFrame:
    return curation.chunks(_decided(spark, sf_dir), _documents(spark, sf_dir), SHORT_LINE)


def normalize_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titled(spark, sf_dir).select("path", "author", "title", "author_key", "title_key")


def dedup_exact(spark, sf_dir):
    grouped = _decided(spark, sf_dir).where("keeper IS NOT NULL")
    return grouped.selectExpr(
        "path", "sha256", "shelf AS corpus", "keeper", "if(path = keeper, 'keep', 'drop') AS decision"
    )


def dedup_format(spark, sf_dir):
    mixed = _decided(spark, sf_dir).where(f"{curation.LIVE} AND best < worst")
    return mixed.select("path", "fmt", "canonical", "decision")


def dedup_decisions(spark, sf_dir):
    return _decided(spark, sf_dir).select("path", "decision", "reason")


def canonical_titles(spark, sf_dir):
    return curation.titles(_decided(spark, sf_dir)).select(
        F.col("shelf").alias("corpus"), "author_key", "title_key", "canonical", "files"
    )


def assign_corpus(spark, sf_dir):
    return _assigned(spark, sf_dir).select("path", "corpus")


def corpus_review(spark, sf_dir):
    return curation.for_review(_assigned(spark, sf_dir))


def layout_plan(spark, sf_dir):
    return _layout(spark, sf_dir).select("path", "target", "claims")


def move_manifest(spark, sf_dir):
    return _moves(spark, sf_dir).select("src", "dst", "action", "inverse_src", "inverse_dst")


def apply_manifest(spark, sf_dir):
    moved = curation.applied(_files(spark, sf_dir), _moves(spark, sf_dir))
    return moved.select("path", "root", "rel_path", "top_folder", "filename", "sha256")


def ordered_moves(spark, sf_dir):
    """A series renumbered: volumes move up by one, German ones change places in pairs, French
    ones stay."""
    number = "CASE lang WHEN 'fr' THEN doc_id WHEN 'de' THEN doc_id ^ 1 ELSE doc_id + 1 END"
    wanted = tables.table(spark, sf_dir, "documents").selectExpr(
        "concat('/lib/vol_', doc_id) AS path", f"concat('/lib/vol_', {number}) AS target"
    )
    folder = f"moves/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    return moves.ordered(wanted, wanted.select("path"), folder)


def conversion_worklist(spark, sf_dir):
    done = _labelled(spark, sf_dir).where("quality = 1").selectExpr("new_sha256 AS sha256")
    held = _decided(spark, sf_dir).select("path", "sha256").join(
        _documents(spark, sf_dir).select("path", "n_chars"), "path"
    )
    return curation.to_convert(_decided(spark, sf_dir), done, held)


def conversion_status(spark, sf_dir):
    """Two batches: poor documents failed in the first, all others were converted; in the second
    harmless poor ones were converted, and the toxic ones tried twice more."""
    folder = f"converted/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    log = conversions.ConversionLog(spark, staging_dir(spark, folder))
    tried = _labelled(spark, sf_dir).withColumnRenamed("new_sha256", "sha256")
    at = "timestamp_seconds(1705000000 + {}) AS at"
    first = tried.where("quality IN (0, 1)").selectExpr(
        "path", "sha256", "if(quality = 1, 'converted', 'failed') AS status", "concat('exit ', quality) AS error",
        at.format("number"),
    )
    again = "explode(if(toxic = 1, array('timeout', 'password'), array('none'))) AS error"
    second = tried.where("quality = 0").selectExpr("*", again).selectExpr(
        "path", "sha256", "if(toxic = 1, 'failed', 'converted') AS status", "error", at.format("5000000")
    )
    log.append(first, "conv-1")
    log.append(second, "conv-2")
    log.compact()
    return conversions.status(_decided(spark, sf_dir), log.states(), LIBRARY)


def citation_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir)


def _content_chunks(spark, sf_dir, text: str = "text") -> DataFrame:
    texts = _documents(spark, sf_dir).selectExpr("path", f"{text} AS text", "doc_id")
    wanted = curation.citable(_decided(spark, sf_dir))
    return passages.content_chunks(wanted.join(texts, "path"))


def content_chunks(spark, sf_dir):
    return _content_chunks(spark, sf_dir).select(
        "path", "corpus", "chunk_no", "location", F.length("chunk").cast("long").alias("n_chars"), "chunk_key"
    )


def embed_worklist(spark, sf_dir):
    """What was embedded: texts of good quality as they were before their first 100 characters
    were added."""
    good = tables.table(spark, sf_dir, "labels").where("quality = 1")
    done = _content_chunks(spark, sf_dir, "substr(text, 101)").join(good, "doc_id", "left_semi")
    return passages.to_embed(_content_chunks(spark, sf_dir), done)


def dedup_near(spark, sf_dir):
    """Titles are spelled by the documents' languages."""
    named = _documents(spark, sf_dir).selectExpr("path", """concat(source, ' - ', CASE lang
        WHEN 'fr' THEN 'Études' WHEN 'de' THEN 'Etuden' WHEN 'es' THEN 'Estude' ELSE 'Étude' END,
        ' No. ', n_chars div 100) AS name""")
    files = curation.with_keeper(curation.titled(_assigned(spark, sf_dir), named))
    folder = f"near/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    return near_titles.near_duplicates(written(files, staging_dir(spark, f"{folder}/files")), folder)


def _ledger(spark, sf_dir) -> DataFrame:
    """The book ledger: an entry per labelled document and one per benchmark item, which is no
    file any more. Poor ones are recorded as notes, toxic ones without an author."""
    documents = tables.table(spark, sf_dir, "documents")
    labelled = documents.join(unsent(tables.table(spark, sf_dir, "labels")), "doc_id").selectExpr(
        "concat('L', doc_id) AS entry_id", f"{IMPRINT} AS isbn",
        "if(toxic = 1, NULL, upper(source)) AS author",
        "concat(if(quality = 0, 'Notes ', 'ETUDE no '), n_chars div 10) AS title",
        "CASE WHEN quality = 0 THEN 'untrusted-nonfiction' WHEN toxic = 1 THEN 'fiction'"
        " WHEN toxic = 0 THEN 'trusted-nonfiction' END AS corpus",
    )
    items = tables.table(spark, sf_dir, "benchmark").selectExpr(
        "concat('B', item_id) AS entry_id", "string(NULL) AS isbn", "'Item' AS author",
        "concat('Reference ', item_id) AS title", "'trusted-nonfiction' AS corpus",
    )
    return labelled.union(items)


# German books have old numbers, and most check digits are wrong.
IMPRINT = """concat('ISBN ', if(lang = 'de', '', '978-'), lpad(n_chars, 9, '0'), '-', CASE
    WHEN lang <> 'de' THEN string(doc_id % 10) WHEN doc_id % 11 = 10 THEN 'X' ELSE string(doc_id % 11) END)"""


def _reconciled(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Files as the scan left them, under names of their own, against the ledger."""
    named = _documents(spark, sf_dir).selectExpr(
        "path", "concat(source, ' - Étude No. ', n_chars div 10) AS name", f"{isbn13(IMPRINT)} AS isbn"
    )
    titled = curation.titled(_files(spark, sf_dir), named)
    folder = f"ledger/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    files = written(curation.with_keeper(titled), staging_dir(spark, f"{folder}/files"))
    return reconcile.reconcile(files, _ledger(spark, sf_dir), folder)


def reconcile_match(spark, sf_dir):
    return _reconciled(spark, sf_dir)[0].drop("sha256")


def reconcile_entries(spark, sf_dir):
    return _reconciled(spark, sf_dir)[1]


def reconcile_report(spark, sf_dir):
    return reconcile.report(*_reconciled(spark, sf_dir))


def ledger_corpus(spark, sf_dir):
    given = reconcile.assignments(_reconciled(spark, sf_dir)[0])
    return curation.assigned(_files(spark, sf_dir), given).select("path", "corpus", "ambiguous")


CELLS, TOP = 64, 5


def _citations(spark, sf_dir) -> DataFrame:
    """(id, path, corpus, author, book) of documents that are files of assigned corpora."""
    ids = _documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "path")
    return curation.citable(_decided(spark, sf_dir)).join(ids, "path").drop("sha256")


def _retrieved(spark, sf_dir, probes: int | None) -> DataFrame:
    """The vector of a document is the one with its number; every fiftieth vector is a query."""
    vectors = retrieval.whole(tables.table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id"))
    cited = _citations(spark, sf_dir)
    folder = staging_dir(spark, f"vectors/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}")
    placed = vectors.join(unsent(cited), "id")
    centres = retrieval.fit_centres(vectors, CELLS, id="id")
    retrieval.write_index(retrieval.index(placed, centres, id="id"), folder)
    found = spark.read.schema("id long, vector array<int>, corpus string, cell int").parquet(folder)
    queries = vectors.where("id % 50 = 0").selectExpr("id", "embedding AS vector")
    best = retrieval.search(found, queries, centres, TOP, probes)
    return best.join(unsent(cited.drop("corpus")), "id").selectExpr(
        "query_id", "corpus", "rank", "id", "score", "path", "author", "book"
    )


def retrieve_topk(spark, sf_dir):
    return _retrieved(spark, sf_dir, None)


def retrieve_indexed(spark, sf_dir):
    """Looks at three quarters of the cells, since these vectors have hardly any neighbourhoods."""
    return _retrieved(spark, sf_dir, CELLS * 3 // 4)


def collection_sizes(spark, sf_dir):
    return curation.collection_sizes(_chunks(spark, sf_dir))


def _earlier_books(spark, sf_dir) -> DataFrame:
    """What the collections held before: harmless and Spanish documents, all in one corpus, German ones
    with another text, every second one without its author."""
    names = _documents(spark, sf_dir).select("path", "lang", "source", "n_chars")
    held = _contents(spark, sf_dir).where("kind = 'documents'").drop("lang").join(names, "path").join(
        tables.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "number"), "number", "left"
    )
    return held.where("toxic = 0 OR lang = 'es'").selectExpr(
        "path", "if(lang = 'de', concat('stale', number), new_sha256) AS sha256",
        "'trusted-nonfiction' AS corpus", "if(n_chars % 2 = 0, '', source) AS author",
        "concat('Étude No. ', n_chars div 100) AS book",
    )


def collection_changes(spark, sf_dir):
    before = _earlier_books(spark, sf_dir).withColumn("slot", F.lit(0))
    return collections.changes(before, curation.citable(_decided(spark, sf_dir))).select(
        "path", "op", "from_corpus", "to_corpus"
    )


def synced_collections(spark, sf_dir):
    """The collections as they were held before, brought to what the catalog wants now."""
    work = f"collections/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    folder = staging_dir(spark, f"{work}/stored")
    texts = _documents(spark, sf_dir)
    earlier = texts.selectExpr("path", "if(lang = 'de', substr(text, 101), text) AS text")
    collections.sync(folder, _earlier_books(spark, sf_dir), earlier, f"{work}/first", SHORT_LINE, slots=16)
    wanted = curation.citable(_decided(spark, sf_dir))
    collections.sync(folder, wanted, texts, f"{work}/second", SHORT_LINE, slots=16)
    return collections.stored(spark, folder).drop("slot")


QUERIES = {
    f.__name__: f
    for f in (
        normalize_title, dedup_exact, dedup_format, dedup_decisions, canonical_titles,
        assign_corpus, corpus_review, layout_plan, move_manifest, apply_manifest, ordered_moves,
        conversion_worklist, conversion_status, citation_chunks, content_chunks, embed_worklist, collection_sizes,
        dedup_near, reconcile_match, reconcile_entries, reconcile_report, ledger_corpus,
        retrieve_topk, retrieve_indexed, collection_changes, synced_collections,
    )
}
