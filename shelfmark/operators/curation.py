"""What follows a scan: titles, decisions on copies, corpora, target layout, texts to ingest.

Nothing here touches a file; every result is a table that says what should be done. Files
that share a content, a title or a target may be a third of the catalog, so each such group
is reduced by partial aggregation to one row, and members are joined to it: no window gathers
a group, and ``rebalance`` on the reduced side lets AQE split a hot key (see ``duplicates``).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import schema as S
from shelfmark.functions import names
from shelfmark.operators import chapters
from shelfmark.sources.staging import unsent

ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
#: Preference among formats of a title, best first.
RANK = "CASE fmt WHEN 'epub' THEN 0 WHEN 'mobi' THEN 1 WHEN 'azw3' THEN 1 WHEN 'pdf' THEN 2 ELSE 3 END"
COPY = "coalesce(path <> keeper, false)"
LIVE = f"missing_since IS NULL AND rag_eligible = 1 AND NOT {COPY}"
TITLE = ["shelf", "author_key", "title_key"]
#: The corpus a file is in, or is hinted to belong to while it has none.
SHELF = f"if(coalesce(corpus, '{S.UNASSIGNED}') = '{S.UNASSIGNED}', coalesce(corpus_hint, '{S.UNASSIGNED}'), corpus)"

_ENDING = "length(substring_index(filename, '.', -1)) + 1"
_STEM = (
    f"if(contains(substring(filename, 2), '.'), left(filename, length(filename) - ({_ENDING})), filename)"
)


def name_key(column: str):
    """Letters and digits in lower case without accents, all else a single space."""
    plain = F.translate(F.lower(column), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def titled(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """``files`` with shelf, author, title and the keys of these two.

    ``metadata`` (path, name; a path once) holds names better than the file's own, which
    is taken without its extension where there is none. "Author - Title" is split at the
    first " - "; without one the author is empty. A null corpus counts as unassigned.
    """
    named = files.join(unsent(metadata), "path", "left").withColumn("name", F.expr(f"coalesce(name, {_STEM})"))
    split = named.withColumn("cut", F.expr("instr(name, ' - ')")).selectExpr(
        "* EXCEPT (name, cut, corpus)", f"coalesce(corpus, '{S.UNASSIGNED}') AS corpus", f"{SHELF} AS shelf",
        "if(cut > 0, left(name, cut - 1), '') AS author",
        "if(cut > 0, substring(name, cut + 3), name) AS title",
    )
    return split.withColumns({"author_key": name_key("author"), "title_key": name_key("title")})


def with_keeper(files: DataFrame) -> DataFrame:
    """``files`` with ``keeper``: of equal contents on a shelf the path to keep, else NULL.

    Files still there come first, then better formats, then those known longer. Copies in
    different corpora, or hinted to belong to different ones, are never compared.
    """
    order = F.expr(f"struct(missing_since IS NOT NULL AS gone, {RANK} AS rank, first_seen, path)")
    keepers = files.where("sha256 IS NOT NULL").groupBy("sha256", "shelf").agg(
        F.min(order).alias("best"), F.count("*").alias("copies")
    ).where("copies > 1").selectExpr("sha256 AS content", "shelf", "best.path AS keeper")
    # files without a hash each get a key of their own, and meet nothing
    keyed = files.withColumn("content", F.expr("coalesce(sha256, path)"))
    return keyed.join(unsent(keepers.hint("rebalance")), ["content", "shelf"], "left").drop("content")


def titles(files: DataFrame) -> DataFrame:
    """One row per title of a shelf among eligible files that are there and no copies:
    canonical (its path of the best format), best and worst rank of its formats, files."""
    return files.where(LIVE).groupBy(*TITLE).agg(
        F.min(F.expr(f"struct({RANK} AS rank, path)")).alias("best"),
        F.expr(f"max({RANK}) AS worst"), F.count("*").alias("files"),
    ).selectExpr(*TITLE, "best.path AS canonical", "best.rank AS best", "worst", "files")


def decided(files: DataFrame) -> DataFrame:
    """``files`` (titled, with keeper) with canonical, best, worst, decision and reason.

    Copies are dropped, other formats than a title's best are for review, the rest is kept.
    """
    best = titles(files).drop("files").hint("rebalance")
    review = f"{LIVE} AND {RANK} > best"
    return files.join(unsent(best), TITLE, "left").selectExpr(
        "*", f"CASE WHEN {COPY} THEN 'drop' WHEN {review} THEN 'review' ELSE 'keep' END AS decision",
        f"CASE WHEN {COPY} THEN 'exact_copy' WHEN {review} THEN 'other_format' END AS reason",
    )


def assigned(files: DataFrame, assignments: DataFrame) -> DataFrame:
    """``files`` with the corpus that ``assignments`` (sha256, corpus) give, and ``ambiguous``.

    A content assigned to different corpora keeps the corpus it has.
    """
    given = assignments.where("sha256 IS NOT NULL AND corpus IS NOT NULL").groupBy("sha256").agg(
        F.expr("if(min(corpus) = max(corpus), min(corpus), NULL) AS given"),
        F.expr("min(corpus) <> max(corpus) AS ambiguous"),
    ).withColumnRenamed("sha256", "content")
    keyed = files.withColumn("content", F.expr("coalesce(sha256, path)"))
    return keyed.join(unsent(given.hint("rebalance")), "content", "left").selectExpr(
        "* EXCEPT (content, given, ambiguous, corpus)",
        f"coalesce(given, corpus, '{S.UNASSIGNED}') AS corpus",
        "coalesce(ambiguous, false) AS ambiguous",
    )


def for_review(files: DataFrame) -> DataFrame:
    """Files that are there and whose corpus (see ``assigned``) needs a look: path, reason."""
    reason = f"""CASE WHEN ambiguous THEN 'ambiguous' WHEN corpus = '{S.UNASSIGNED}' THEN corpus
        WHEN corpus_hint <> '{S.UNASSIGNED}' AND corpus_hint <> corpus THEN 'hint_differs' END"""
    found = files.where("missing_since IS NULL").withColumn("reason", F.expr(reason))
    return found.where("reason IS NOT NULL").select("path", "corpus", "corpus_hint", "reason")


def layout(files: DataFrame, library: str) -> DataFrame:
    """(path, root, decision, target, claims) of decided files that are there and no copies.

    Eligible files go to corpus/author/title/title.ext below ``library``, others to
    _non_rag and their whole path. An eligible file without a corpus is for review and
    stays where it is. ``claims`` counts the files that want a target or lie there.
    """
    homeless = f"rag_eligible = 1 AND corpus = '{S.UNASSIGNED}'"
    kept = files.where("missing_since IS NULL AND decision <> 'drop'").selectExpr(
        "path", "root", f"if({homeless}, 'review', decision) AS decision",
        f"""CASE WHEN {homeless} THEN path WHEN rag_eligible = 1 THEN
            concat_ws('/', '{library}', corpus, if(author_key = '', 'unknown', author_key),
                      if(title_key = '', 'untitled', title_key),
                      concat(if(title_key = '', 'untitled', title_key), '.', ext))
            ELSE concat('{library}/_non_rag', path) END AS target""",
    )
    lying = files.where("missing_since IS NULL").select("path").join(
        kept.where("path = target").select("path"), "path", "left_anti"
    )
    claims = kept.select("target").union(lying).groupBy("target").agg(F.count("*").alias("claims"))
    return kept.join(claims.hint("rebalance"), "target")


def manifest(plan: DataFrame, library: str) -> DataFrame:
    """Moves of a ``layout`` with their inverses. A target claimed twice is a conflict, what
    is under review stays where it is; neither has a destination."""
    action = """CASE WHEN decision = 'review' THEN 'review' WHEN path = target THEN 'stay'
        WHEN claims > 1 THEN 'conflict' ELSE 'move' END"""
    moves = plan.selectExpr("path AS src", "root AS src_root", "target", f"{action} AS action")
    return moves.selectExpr(
        "src", "if(action = 'move', target, NULL) AS dst", "action",
        "if(action = 'move', target, NULL) AS inverse_src",
        "if(action = 'move', src, NULL) AS inverse_dst",
        "src_root", f"if(action = 'move', '{library}', NULL) AS dst_root",
    )


def inverse(moves: DataFrame) -> DataFrame:
    """The manifest that takes the moves of ``moves`` back."""
    return moves.where("action = 'move'").selectExpr(
        "inverse_src AS src", "inverse_dst AS dst", "action", "src AS inverse_src",
        "dst AS inverse_dst", "dst_root AS src_root", "src_root AS dst_root",
    )


def applied(files: DataFrame, moves: DataFrame) -> DataFrame:
    """The catalog after the moves: path, root and path parts follow, all else stays."""
    to = moves.where("action = 'move'").selectExpr("src AS path", "dst", "dst_root")
    rel, new = names.rel_path("path", "root"), ["path", "root", "rel_path", "top_folder", "filename"]
    placed = files.join(to, "path", "left").withColumns({
        "root": F.expr("coalesce(dst_root, root)"), "path": F.expr("coalesce(dst, path)"),
    }).drop("dst", "dst_root")
    placed = placed.withColumn("rel_path", F.expr(rel)).withColumns({
        "top_folder": F.expr(names.top_folder("rel_path")), "filename": F.expr(names.filename("path")),
    })
    return placed.select(*new, *[c for c in files.columns if c not in new])


def to_convert(files: DataFrame, converted: DataFrame, extracted: DataFrame) -> DataFrame:
    """Kept eligible files that are no EPUB and whose content is not in ``converted`` (sha256).

    ``extracted`` (sha256, n_chars) tells what text a content holds; a PDF with none is for OCR.
    """
    wanted = files.where(f"{LIVE} AND decision = 'keep' AND fmt <> 'epub'").withColumn(
        "content", F.expr("coalesce(sha256, path)")
    )
    done = converted.selectExpr("sha256 AS content").distinct()
    sizes = extracted.where("sha256 IS NOT NULL").groupBy("sha256").agg(
        F.max("n_chars").alias("n_chars")
    ).withColumnRenamed("sha256", "content")
    left = wanted.join(done.hint("rebalance"), "content", "left_anti")
    return left.join(sizes.hint("rebalance"), "content", "left").selectExpr(
        "path", "sha256", "fmt", "fmt = 'pdf' AND coalesce(n_chars, 0) = 0 AS ocr"
    )


def citable(files: DataFrame) -> DataFrame:
    """(path, sha256, corpus, author, book) of kept eligible files of assigned corpora."""
    return files.where(f"{LIVE} AND decision = 'keep' AND corpus <> '{S.UNASSIGNED}'").select(
        "path", "sha256", "corpus", F.col("author"), F.col("title").alias("book")
    )


def chunks(files: DataFrame, texts: DataFrame, heading: str = chapters.HEADING) -> DataFrame:
    """Passages of kept eligible files of assigned corpora with what a citation needs: chapter,
    place in it and the file's columns (see ``chapters``). ``texts`` (path, text) are whole texts."""
    wanted = citable(files)
    return chapters.chapter_chunks(wanted.join(texts.select("path", "text"), "path"), heading=heading)


def collection_sizes(passages: DataFrame) -> DataFrame:
    return passages.groupBy("corpus").agg(
        F.expr("count_if(chapter_no = 0 AND chunk_no = 0) AS files"), F.count("*").alias("chunks"),
        F.sum(F.length("chunk")).alias("chars"),
    )
