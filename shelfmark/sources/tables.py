"""Catalog inputs derived from tables whose rows stand for stored files.

Every row of ``documents``, ``pages`` and ``conversations`` is a file that a scan
of the roots /lib and /web meets now. The prior snapshot knows every document
and page too, and in addition every row of ``benchmark`` (files deleted since)
and of ``labels`` (files under /other, a root not scanned). No table is cut; what
happened to a file since the last scan follows from its own columns:

* documents labelled low quality lay in another folder (moved since),
* French ones had another size (changed), Spanish ones were never hashed,
* toxic ones were flagged missing before (they reappear, or stay missing if moved),
* good, harmless ones have an assigned corpus.

Sizes and hashes of contents are computed in the scan of each table, so no text
ever passes through a shuffle.
"""

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from shelfmark import schema as S
from shelfmark.functions import names
from shelfmark.operators.merge import Run
from shelfmark.sources.staging import unsent

ROOTS = ("/lib", "/web")
PRIOR_RUN = "inv-20240101T030000-000000Z"
PRIOR_SCAN_AT = 1704078000  # 2024-01-01 03:00:00 UTC
FLAGGED_AT = 1704682800  # 2024-01-08 03:00:00 UTC
RUN = Run(
    run_id="inv-20240115T030000-000000Z",
    now=datetime(2024, 1, 15, 3, tzinfo=timezone.utc),
    roots=ROOTS,
)

# Known column types spare a look into the files before each query.
COLUMNS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
}

FOLDER = """get(array('Nonfiction/', 'Fiction/', '15000KindleBooks/', 'AudioBooks/',
    'ComicBookPDFs/', 'Ghostwriting/', 'Apologetics/', ''), int(doc_id % 8))"""
SUFFIX = """get(array('.mobi', '.EPUB', '.pdf', '.mp3', '.cbz', '.jpg', '.zip', '.azw.res',
    '.xyz', '', '.azw3', '.txt'), int(doc_id % 12))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _document_path(folder: str) -> str:
    return f"concat('/lib/', {folder}, source, '_', doc_id, {SUFFIX})"


# What each table's rows are as files: number, path, content, mtime.
FILES_OF = {
    "documents": ("doc_id", _document_path(FOLDER), "text", "doc_id + 1700000000.25D"),
    "pages": (
        # A URL that ends in a slash names a folder; its file is the index page.
        "page_id",
        "concat('/web/', replace(url, '://', '/'), if(endswith(url, '/'), 'index.html', ''))",
        "html", "page_id + 1690000000.5D",
    ),
    "conversations": (
        "turn", "concat('/lib/Client Notes/conv_', conv_id, '/', turn, '_', role, '.txt')",
        "text", "turn + 1705000000",
    ),
    "benchmark": (
        "item_id", "concat('/lib/Reference/item_', item_id, '.pdf')", "text",
        "item_id + 1680000000",
    ),
    "labels": (
        "doc_id", "concat('/other/labels/', doc_id, '.txt')", "concat(quality, '/', toxic)",
        "doc_id + 1670000000",
    ),
}


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file of any table, with size and hash of its content.

    The only step that reads texts. ``lang`` and ``moved_path`` are set for documents.
    Where it is stored, ``rebalance`` it: rows are far smaller than the texts, so
    one output file per scan task would be tiny.
    """
    parts = []
    for name, (number, path, content, mtime) in FILES_OF.items():
        is_document = name == "documents"
        parts.append(table(spark, sf_dir, name).selectExpr(
            f"'{name}' AS kind", f"{number} AS number", f"{path} AS path",
            f"bigint(octet_length({content})) AS size_bytes", f"double({mtime}) AS mtime",
            f"sha2({content}, 256) AS new_sha256",
            f"{'lang' if is_document else 'string(NULL)'} AS lang",
            (_document_path("'Incoming/'") if is_document else "string(NULL)") + " AS moved_path",
        ))
    return reduce(DataFrame.union, parts)


def entries(files: DataFrame) -> DataFrame:
    """What a scan of /lib and /web meets: one row per file, with its content hash."""
    return files.where("kind IN ('documents', 'conversations', 'pages')").selectExpr(
        "if(kind = 'pages', 1, 0) AS root_ordinal", "if(kind = 'pages', '/web', '/lib') AS root",
        "path", "size_bytes", "mtime", "string(NULL) AS error", "new_sha256",
        "string(NULL) AS hash_error",
    )


def with_inner_root(entries: DataFrame) -> DataFrame:
    """The same scan with /lib/Fiction as a third root, whose files it meets twice."""
    inner = entries.where("startswith(path, '/lib/Fiction/')").selectExpr(
        "* EXCEPT (root_ordinal, root)", "2 AS root_ordinal", "'/lib/Fiction' AS root"
    )
    return entries.unionByName(inner)


def prior_catalog(files: DataFrame, labels: DataFrame) -> DataFrame:
    """The stored snapshot of the scan before, in the catalog's schema."""
    documents = files.where("kind = 'documents'").join(
        unsent(labels.withColumnRenamed("doc_id", "number")), "number", "left"
    ).selectExpr(
        "number * 4 + 1 AS id",
        "'/lib' AS root",
        "if(quality = 0, moved_path, path) AS path",
        "size_bytes + if(lang = 'fr', 1L, 0L) AS size_bytes",
        "mtime",
        "CASE lang WHEN 'fr' THEN concat('stale', number) WHEN 'es' THEN NULL ELSE new_sha256 END"
        " AS sha256",
        f"if(quality = 1 AND toxic = 0, 'trusted-nonfiction', '{S.UNASSIGNED}') AS corpus",
        f"if(toxic = 1, timestamp_seconds({FLAGGED_AT}), NULL) AS missing_since",
    )
    others = files.where("kind IN ('pages', 'benchmark', 'labels')").selectExpr(
        "number * 4 + CASE kind WHEN 'pages' THEN 2 WHEN 'benchmark' THEN 3 ELSE 4 END AS id",
        "CASE kind WHEN 'pages' THEN '/web' WHEN 'benchmark' THEN '/lib' ELSE '/other' END AS root",
        "path", "size_bytes", "mtime", "new_sha256 AS sha256", f"'{S.UNASSIGNED}' AS corpus",
        "timestamp(NULL) AS missing_since",
    )
    first = f"timestamp_seconds({PRIOR_SCAN_AT})"
    values = {
        "sha256": f"if(category <> '{S.METADATA_CATEGORY}', sha256, NULL)",
        "run_id": f"'{PRIOR_RUN}'", "first_seen": first, "last_seen": first,
        "error": "string(NULL)",
    }
    return names.described(documents.union(others)).selectExpr(
        *[f"{values.get(c, c)} AS {c}" for c in S.FILE_COLUMNS]
    )
