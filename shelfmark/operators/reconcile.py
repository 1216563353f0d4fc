"""Files against a ledger of books: what is recorded, what lies on disk, where they differ.

A file looks for its entry by its strongest key that any entry has: ISBN, then author and
title, then title alone where one of the two sides names no author. Files and entries never
meet in pairs. Both meet keys: entries of a key are counted before files are joined to it, so a
title that a third of the files and of the ledger share costs one row per file and per entry.

Files and entries with their keys form a graph. A key of several entries is a conflict, and
the entries that conflicts link form a group, named by its smallest entry: these have to be
looked at together.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import schema as S
from shelfmark.functions.isbn import isbn13
from shelfmark.operators.components import components
from shelfmark.operators.curation import LIVE, name_key
from shelfmark.sources.staging import staging_dir, unsent, written

KEY = ["kind", "value"]
#: What a unique match may differ in, as (field, condition that both sides are known and differ).
FIELDS = (
    ("isbn", "isbn <> entry_isbn"),
    ("author", "author_key <> '' AND entry_author <> '' AND author_key <> entry_author"),
    ("title", "title_key <> '' AND entry_title <> '' AND title_key <> entry_title"),
    ("corpus", f"corpus <> '{S.UNASSIGNED}' AND corpus <> entry_corpus"),
)
#: Matches best first; an entry counts by its best.
STATUS = ("matched", "mismatch", "conflict")


def _keys(of_file: bool) -> str:
    """Keys of a row, strongest first.

    Entries are posted under their title for files without an author, and once more, where they
    name none themselves, for files with one.
    """
    bare = "if(author_key = '', 'title', 'open_title')" if of_file else "'title'"
    keys = [
        "if(isbn IS NOT NULL, struct('isbn' AS kind, isbn AS value), NULL)",
        "if(author_key <> '' AND title_key <> '',"
        " struct('author_title' AS kind, concat(author_key, ' / ', title_key) AS value), NULL)",
        f"if(title_key <> '', struct({bare} AS kind, title_key AS value), NULL)",
    ]
    if not of_file:
        keys.append("if(author_key = '' AND title_key <> '',"
                    " struct('open_title' AS kind, title_key AS value), NULL)")
    return f"array({', '.join(keys)})"


def ledger(entries: DataFrame) -> DataFrame:
    """``entries`` (entry_id, isbn, author, title, corpus; all text) with comparable keys.

    A row without an id is no entry. An id in several rows is one entry, its fields those of the
    first row in the order of isbn, author, title and corpus (nulls first). An ISBN with a wrong
    check digit is none.
    """
    fields = [f"{isbn13('isbn')} AS isbn", "coalesce(author, '') AS author", "coalesce(title, '') AS title", "corpus"]
    known = entries.where("entry_id IS NOT NULL").selectExpr("entry_id", *fields)
    one = known.groupBy("entry_id").agg(F.min(F.struct("isbn", "author", "title", "corpus")).alias("row"))
    return one.select("entry_id", "row.*").withColumns(
        {"author_key": name_key("author"), "title_key": name_key("title")}
    )


def _posted(rows: DataFrame, id: str, of_file: bool) -> DataFrame:
    """(id, level, kind, value) for each key of a row."""
    keys = F.posexplode(F.expr(_keys(of_file))).alias("level", "key")
    return rows.select(id, keys).where("key IS NOT NULL").select(id, "level", "key.*")


def _best_keys(files: DataFrame, postings: DataFrame) -> DataFrame:
    """(path, kind, value, candidates, first): the strongest key of each file that entries have."""
    held = postings.groupBy(*KEY).agg(
        F.count("*").alias("candidates"), F.min("entry_id").alias("first")
    )
    met = _posted(files, "path", True).join(unsent(held.hint("rebalance")), KEY)
    return met.groupBy("path").agg(
        F.min(F.struct("level", *KEY, "candidates", "first")).alias("best")
    ).select("path", "best.kind", "best.value", "best.candidates", "best.first")


def _groups(entries: DataFrame, postings: DataFrame, best: DataFrame, name: str) -> DataFrame:
    """``entries`` with ``group_id`` and ``group_entries``.

    Only keys that some file meets and that name several entries link these.
    """
    crowded = best.where("candidates > 1").select(*KEY).distinct()
    # entries sort before keys, so a group's smallest node is an entry
    links = postings.join(unsent(crowded.hint("rebalance")), KEY).selectExpr(
        "concat('0', entry_id) AS a", "concat('1', kind, ':', value) AS b"
    )
    found = components(links, name).where("startswith(node, '0')").selectExpr(
        "substr(node, 2) AS entry_id", "substr(root, 2) AS root"
    )
    grouped = entries.join(unsent(found), "entry_id", "left").withColumn("group_id", F.expr("coalesce(root, entry_id)"))
    sizes = grouped.groupBy("group_id").agg(F.count("*").alias("group_entries"))
    return grouped.drop("root").join(unsent(sizes.hint("rebalance")), "group_id")


def reconcile(files: DataFrame, entries: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """What becomes of files and of entries: two tables, below ``name`` in the staging folder.

    ``files`` are titled, have keepers and ``isbn`` (13 digits or null); those that are there,
    eligible and no copies take part. The first table has a row for each: path, sha256, matched_by
    (isbn, author_title, title or null), entry_id (the smallest that has the key), candidates
    (entries that have it), group_id, group_entries, differs (fields of a unique match that
    differ, by comma), status: matched, mismatch, conflict (several candidates) or disk_only;
    ledger_corpus is the corpus of a unique match.

    The second has a row per entry: entry_id, status (the best any file gives it, or ledger_only),
    files (that meet it by their strongest key), group_id, group_entries.
    """
    spark = files.sparkSession

    def staged(df, step):
        return written(df, staging_dir(spark, f"{name}/{step}"))

    live = files.where(LIVE).select("path", "sha256", "isbn", "author_key", "title_key", "corpus")
    known = staged(ledger(entries), "ledger")
    postings = staged(_posted(known, "entry_id", False).drop("level"), "postings")
    best = staged(_best_keys(live, postings), "best")
    grouped = staged(_groups(known, postings, best, f"{name}/groups"), "grouped")

    sides = grouped.selectExpr(
        "entry_id", "isbn AS entry_isbn", "author_key AS entry_author", "title_key AS entry_title",
        "corpus AS entry_corpus", "group_id", "group_entries",
    )
    named = best.withColumnRenamed("first", "entry_id").join(unsent(sides.hint("rebalance")), "entry_id")
    differs = ", ".join(f"if({condition}, '{field}', NULL)" for field, condition in FIELDS)
    matches = staged(live.join(unsent(named), "path", "left").withColumn(
        "differs", F.expr(f"if(candidates = 1, nullif(array_join(array({differs}), ','), ''), NULL)")
    ).selectExpr(
        "path", "sha256", "kind", "value", "if(kind = 'open_title', 'title', kind) AS matched_by",
        "entry_id", "coalesce(candidates, 0L) AS candidates", "group_id", "group_entries", "differs",
        """CASE WHEN entry_id IS NULL THEN 'disk_only' WHEN candidates > 1 THEN 'conflict'
           WHEN differs IS NOT NULL THEN 'mismatch' ELSE 'matched' END AS status""",
        "if(candidates = 1, entry_corpus, NULL) AS ledger_corpus",
    ), "matches")

    rank = "array_position(array({}), status)".format(", ".join(f"'{s}'" for s in STATUS))
    met = matches.where("kind IS NOT NULL").groupBy(*KEY).agg(
        F.min(F.expr(rank)).alias("rank"), F.count("*").alias("files")
    )
    seen = postings.join(unsent(met.hint("rebalance")), KEY).groupBy("entry_id").agg(
        F.min("rank").alias("rank"), F.sum("files").alias("files")
    )
    statuses = ", ".join(f"'{s}'" for s in STATUS)
    recorded = grouped.join(unsent(seen), "entry_id", "left").selectExpr(
        "entry_id", f"coalesce(get(array({statuses}), int(rank) - 1), 'ledger_only') AS status",
        "coalesce(files, 0L) AS files", "group_id", "group_entries",
    )
    return matches.drop(*KEY), staged(recorded, "recorded")


def report(matches: DataFrame, recorded: DataFrame) -> DataFrame:
    """Files, entries and groups of several entries per status; a status on one side has 0 on the other."""
    files = matches.groupBy("status").agg(F.count("*").alias("files"))
    entries = recorded.groupBy("status").agg(
        F.count("*").alias("entries"),
        F.count_distinct(F.expr("if(group_entries > 1, group_id, NULL)")).alias("open_groups"),
    )
    return files.join(entries, "status", "full").na.fill(0, ["files", "entries", "open_groups"])


def assignments(matches: DataFrame) -> DataFrame:
    """(sha256, corpus) as ``curation.assigned`` takes them, from unique matches."""
    return matches.where("ledger_corpus IS NOT NULL AND sha256 IS NOT NULL").selectExpr(
        "sha256", "ledger_corpus AS corpus"
    ).distinct()
