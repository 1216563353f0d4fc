"""The same results in DuckDB SQL, written independently of the Spark operators.

Each text stands alone: common table expressions derive the census and the prior
snapshot from the driver's tables, and the last SELECT is the query.
"""

from shelfmark import schema as S

NOW = "2024-01-15T03:00:00+00:00"
THEN = "2024-01-01T03:00:00+00:00"
FLAGGED = "2024-01-08T03:00:00+00:00"
RUN_ID = "inv-20240115T030000-000000Z"
PRIOR_ID = "inv-20240101T030000-000000Z"

FOLDERS = (
    "(['Nonfiction/', 'Fiction/', '15000KindleBooks/', 'AudioBooks/', 'ComicBookPDFs/',"
    " 'Ghostwriting/', 'Apologetics/', ''])[(doc_id % 8 + 1)::INT]"
)
SUFFIX = (
    "(['.mobi', '.EPUB', '.pdf', '.mp3', '.cbz', '.jpg', '.zip', '.azw.res', '.xyz', '',"
    " '.azw3', '.txt'])[(doc_id % 12 + 1)::INT]"
)
PAGE = (
    "'/web/' || replace(url, '://', '/')"
    " || CASE WHEN url LIKE '%/' THEN 'index.html' ELSE '' END"
)


def _formats() -> str:
    rows = [
        f"('{ext}', '{S.SAME_FORMAT.get(ext, ext)}', '{category}', "
        f"{1 if category in ('ebook_text', 'pdf') else 0})"
        for category, exts in S.EXTENSIONS.items() for ext in exts
    ]
    return "formats(e, f, c, r) AS (VALUES " + ", ".join(rows) + ")"


def _hint(text: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"{text} ILIKE '%{n}%'" for n in needles) + f" THEN '{corpus}'"
        for corpus, needles in S.CORPUS_KEYWORDS
    )
    return f"CASE {cases} ELSE 'unassigned' END"


def _described(name: str, source: str) -> str:
    return f"""{name} AS (
      SELECT * EXCLUDE (e, f, c, r), coalesce(f, 'unknown') AS fmt,
             coalesce(c, 'other') AS category,
             coalesce(r, 0) AS rag_eligible, {_hint('path')} AS corpus_hint
      FROM (SELECT *, CASE WHEN rel_path LIKE '%/%' THEN split_part(rel_path, '/', 1) ELSE '' END
                     AS top_folder,
                   CASE WHEN strpos(substr(filename, 2), '.') = 0 THEN ''
                        ELSE lower(split_part(filename, '.', -1)) END AS ext
            FROM (SELECT *, substr(path, length(root) + 2) AS rel_path,
                         split_part(path, '/', -1) AS filename FROM {source}))
      LEFT JOIN formats ON ext = e)"""


ENTRIES = f"""
  docs AS (SELECT doc_id, lang, '/lib/' || {FOLDERS} || source || '_' || doc_id || {SUFFIX} AS path,
                  '/lib/Incoming/' || source || '_' || doc_id || {SUFFIX} AS moved_path,
                  strlen(text) AS size_bytes, doc_id + 1700000000.25::DOUBLE AS mtime,
                  sha256(text) AS sha FROM documents),
  web AS (SELECT page_id, {PAGE} AS path, strlen(html) AS size_bytes,
                 page_id + 1690000000.5::DOUBLE AS mtime, sha256(html) AS sha FROM pages),
  entries AS (
    SELECT 0 AS ord, '/lib' AS root, path, size_bytes, mtime, sha FROM docs
    UNION ALL
    SELECT 0, '/lib', '/lib/Client Notes/conv_' || conv_id || '/' || turn || '_' || role || '.txt',
           strlen(text), (turn + 1705000000)::DOUBLE, sha256(text) FROM conversations
    UNION ALL
    SELECT 1, '/web', path, size_bytes, mtime, sha FROM web)"""

# Files of a folder come before its subfolders: mark every folder name with a
# leading byte that sorts after the one put before the file name.
WALK_KEY = (
    "regexp_replace(regexp_replace(substr(path, length(root) + 2), '([^/]+)/', chr(2) || '\\1'"
    " || chr(0), 'g'), '([^' || chr(0) || ']+)$', chr(1) || '\\1')"
)

PRIOR = f"""
  labelled AS (SELECT docs.*, quality, toxic FROM docs LEFT JOIN labels USING (doc_id)),
  prior_raw AS (
    SELECT doc_id * 4 + 1 AS id, '/lib' AS root,
           CASE WHEN quality = 0 THEN moved_path ELSE path END AS path,
           CASE WHEN lang = 'fr' THEN size_bytes + 1 ELSE size_bytes END AS size_bytes, mtime,
           CASE lang WHEN 'fr' THEN 'stale' || doc_id WHEN 'es' THEN NULL ELSE sha END AS sha,
           CASE WHEN quality = 1 AND toxic = 0 THEN 'trusted-nonfiction' ELSE 'unassigned' END
             AS corpus,
           CASE WHEN toxic = 1 THEN '{FLAGGED}' END AS missing_since
    FROM labelled
    UNION ALL
    SELECT page_id * 4 + 2, '/web', path, size_bytes, mtime, sha, 'unassigned', NULL FROM web
    UNION ALL
    SELECT item_id * 4 + 3, '/lib', '/lib/Reference/item_' || item_id || '.pdf', strlen(text),
           (item_id + 1680000000)::DOUBLE, sha256(text), 'unassigned', NULL FROM benchmark
    UNION ALL
    SELECT doc_id * 4 + 4, '/other', '/other/labels/' || doc_id || '.txt', 3,
           (doc_id + 1670000000)::DOUBLE, sha256(quality || '/' || toxic), 'unassigned', NULL
    FROM labels),
  {_described('prior_named', 'prior_raw')},
  prior AS (SELECT * REPLACE (CASE WHEN category <> 'metadata' THEN sha END AS sha)
            FROM prior_named)"""

LISTING = "listing AS (SELECT *, 1 AS visits FROM now_files)"
INNER = """
  twice AS (SELECT * FROM entries UNION ALL
            SELECT 2, '/lib/Fiction', path, size_bytes, mtime, sha FROM entries
            WHERE path LIKE '/lib/Fiction/%'),
  last_visit AS (SELECT path, size_bytes, mtime, sha, arg_max(root, ord) AS root, count(*) AS visits
                 FROM twice GROUP BY ALL)"""


def _both(cap=None, rehash=False, hashing=True, roots="'/lib', '/web'", partial=False) -> str:
    """Listing and prior side by side with hash action and change class."""
    reuse = "" if rehash else (
        "WHEN n.size_bytes = p.size_bytes AND n.mtime = p.mtime AND p.sha IS NOT NULL THEN 'reuse'"
    )
    capped = f"WHEN n.size_bytes > {cap} THEN 'skip'" if cap else ""
    off = "" if hashing else "WHEN true THEN 'skip'"
    stale = "false" if partial else (
        f"(n.path IS NULL AND p.root IN ({roots}))"
    )
    return f"""both_sides AS (
      SELECT coalesce(n.path, p.path) AS k, n, p, n.path IS NOT NULL AS seen,
             p.path IS NOT NULL AS known, {stale} AS stale,
             CASE WHEN n.path IS NULL THEN NULL {off} WHEN n.category = 'metadata' THEN 'skip'
                  {reuse} {capped} ELSE 'hash' END AS action,
             CASE WHEN {stale} THEN 'missing' WHEN n.path IS NULL THEN 'carried'
                  WHEN p.path IS NULL THEN 'new'
                  WHEN n.size_bytes = p.size_bytes AND n.mtime = p.mtime THEN 'unchanged'
                  ELSE 'changed' END AS change
      FROM listing n FULL JOIN prior p ON n.path = p.path)"""


def _files(corpus="preserve", no_hash=None, prune=False) -> str:
    kept = "NULL"
    if no_hash == "keep":
        kept = (
            "CASE WHEN n.category <> 'metadata' AND n.size_bytes = p.size_bytes"
            " AND n.mtime = p.mtime THEN p.sha END"
        )
    seen_corpus = "coalesce(p.corpus, 'unassigned')" if corpus == "preserve" else "'unassigned'"

    def either(column):
        return f"CASE WHEN seen THEN n.{column} ELSE p.{column} END AS {column}"

    named = ", ".join(either(c) for c in (
        "root", "rel_path", "top_folder", "filename", "ext", "fmt", "category", "rag_eligible",
        "size_bytes", "mtime", "corpus_hint",
    ))
    return f"""files AS (
      SELECT p.id AS old_id, k AS path, {named},
             CASE WHEN NOT seen THEN p.sha WHEN action = 'hash' THEN n.sha
                  WHEN action = 'reuse' THEN p.sha ELSE {kept} END AS sha256,
             CASE WHEN NOT seen THEN p.corpus ELSE {seen_corpus} END AS corpus,
             CASE WHEN seen THEN '{RUN_ID}' ELSE '{PRIOR_ID}' END AS run_id,
             CASE WHEN known THEN '{THEN}' ELSE '{NOW}' END AS first_seen,
             CASE WHEN seen THEN '{NOW}' ELSE '{THEN}' END AS last_seen,
             CASE WHEN stale THEN coalesce(p.missing_since, '{NOW}')
                  WHEN NOT seen THEN p.missing_since END AS missing_since,
             NULL::VARCHAR AS error, coalesce(n.visits, 0) AS visits, action
      FROM both_sides {"WHERE NOT stale" if prune else ""})"""


GROUPS = """groups AS (
      SELECT sha256, max(size_bytes)::BIGINT AS size_bytes, count(*)::BIGINT AS copies FROM files
      WHERE sha256 IS NOT NULL GROUP BY sha256 HAVING count(*) > 1)"""

# Sums of a scan; a path met twice counts twice, but finds its hash the second time.
COUNTERS = """
  coalesce(sum(visits), 0)::BIGINT AS files_seen,
  count(*) FILTER (action = 'hash' AND sha256 IS NOT NULL)::BIGINT AS files_hashed,
  coalesce(sum(size_bytes * visits), 0)::BIGINT AS bytes_total,
  coalesce(sum(visits) FILTER (error IS NOT NULL), 0)::BIGINT AS errors
  FROM files WHERE visits > 0"""


def _summary(where="true") -> str:
    return f"""
      SELECT 'total_files' AS metric, '' AS key, count(*)::BIGINT AS value FROM files WHERE {where}
      UNION ALL SELECT 'rag_eligible', '', coalesce(sum(rag_eligible), 0)::BIGINT
        FROM files WHERE {where}
      UNION ALL SELECT 'total_bytes', '', coalesce(sum(size_bytes), 0)::BIGINT
        FROM files WHERE {where}
      UNION ALL SELECT 'by_category', category, count(*) FROM files WHERE {where} GROUP BY category
      UNION ALL SELECT 'by_corpus_hint', corpus_hint, count(*) FROM files WHERE {where}
        GROUP BY corpus_hint
      UNION ALL SELECT 'duplicate_groups', '', count(*) FROM ({_sizes(where)})
      UNION ALL SELECT 'files_in_dup_groups', '', coalesce(sum(copies), 0)::BIGINT
        FROM ({_sizes(where)})"""


def _sizes(where: str) -> str:
    return (
        f"SELECT count(*) AS copies FROM files WHERE sha256 IS NOT NULL AND {where}"
        " GROUP BY sha256 HAVING count(*) > 1"
    )


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts)


def _named(select: str) -> str:
    return f"{_with(_formats(), ENTRIES, _described('now_files', 'entries'))} {select}"


def _sides(select: str, listing=LISTING, **run) -> str:
    named = _described("now_files", "entries")
    return f"{_with(_formats(), ENTRIES, named, PRIOR, listing, _both(**run))} {select}"


def _after(select: str, listing=LISTING, corpus="preserve", no_hash=None, prune=False, **run):
    if no_hash:
        run["hashing"] = False
    extra = f", {_files(corpus, no_hash, prune)}, {GROUPS}"
    return _sides(extra + " " + select, listing, **run)


INNER_LISTING = f"{INNER}, {_described('inner_files', 'last_visit')}, " + (
    "listing AS (SELECT * FROM inner_files)"
)
INNER_ROOTS = "'/lib', '/web', '/lib/Fiction'"
REACHED = f"""reached AS (SELECT path AS rp FROM entries ORDER BY ord, {WALK_KEY} LIMIT 500),
  listing AS (SELECT now_files.*, 1 AS visits FROM now_files JOIN reached ON path = rp)"""

# Names a scan leaves out, tested on every component below the root.
EXCLUDED = (
    r"(^|/)(\.git|\.Trash-[^/]*|@eaDir|lost\+found|__MACOSX|\.DS_Store|Thumbs\.db|[^/]*\.tmp"
    r"|[^/]*\.part|[^/]*\.crdownload|[^/]*\.opdownload|AudioBooks|[^/]*\.zip|src1[^/]_[^/]*"
    r"|conv_[^0-4/][^/]*)(/|$)"
)
SHOWN_MTIME = "mtime::VARCHAR"

ORACLES = {
    "path_parts": _named("SELECT path, root, rel_path, top_folder, filename FROM now_files"),
    "file_ext": _named("SELECT path, ext FROM now_files"),
    "classify_formats": _named(
        "SELECT path, fmt, category, rag_eligible::INT AS rag_eligible FROM now_files"
    ),
    "corpus_hint": _named("SELECT path, corpus_hint FROM now_files"),
    "corpus_hint_top_folder": _named(
        f"SELECT path, {_hint('top_folder')} AS corpus_hint FROM now_files"
    ),
    "file_attributes": _named(
        "SELECT path, root, size_bytes::BIGINT AS size_bytes, mtime, NULL::VARCHAR AS error"
        " FROM now_files"
    ),
    "content_hash": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "content_hash_capped":
        "SELECT doc_id, CASE WHEN strlen(text) <= 4000 THEN sha256(text) END AS sha256"
        " FROM documents",
    "census_excluded": _named(
        f"SELECT path FROM now_files WHERE NOT regexp_matches(rel_path, '{EXCLUDED}')"
    ),
    "census_limit": f"WITH {ENTRIES} SELECT path FROM entries ORDER BY ord, {WALK_KEY} LIMIT 500",
    "overlapping_roots":
        f"WITH {ENTRIES}, {INNER} SELECT path, root, visits::BIGINT AS visits FROM last_visit",
    "overlapping_roots_counters": _after(
        f"SELECT {COUNTERS}", listing=INNER_LISTING, roots=INNER_ROOTS
    ),
    "prior_signatures": _sides(
        "SELECT k AS path, p.size_bytes::BIGINT AS size_bytes, p.mtime AS mtime, p.sha AS sha256,"
        f" CASE WHEN known THEN '{THEN}' END AS first_seen FROM both_sides WHERE seen"
    ),
    "hash_plan": _sides("SELECT k AS path, action FROM both_sides WHERE seen"),
    "hash_plan_rehash": _sides("SELECT k AS path, action FROM both_sides WHERE seen", rehash=True),
    "hash_plan_capped": _sides("SELECT k AS path, action FROM both_sides WHERE seen", cap=4000),
    "lineage": _after(
        "SELECT path, run_id, corpus, first_seen, last_seen, missing_since FROM files"
    ),
    "rag_eligible_files": _after(
        "SELECT path, fmt, size_bytes::BIGINT AS size_bytes FROM files WHERE rag_eligible = 1"
    ),
    "files_by_category": _after("SELECT category, count(*) AS n FROM files GROUP BY category"),
    "files_by_corpus_hint": _after(
        "SELECT corpus_hint, count(*) AS n FROM files GROUP BY corpus_hint"
    ),
    "duplicate_groups": _after("SELECT sha256, size_bytes, copies FROM groups"),
    "duplicate_groups_top": _after(
        "SELECT sha256, size_bytes, copies FROM groups ORDER BY copies DESC, sha256"
    ),
    "duplicate_members": _after(
        "SELECT sha256, g.size_bytes AS size_bytes, copies, path"
        " FROM files JOIN groups g USING (sha256)"
    ),
    "duplicate_totals": _after(
        "SELECT count(*) AS duplicate_groups,"
        " coalesce(sum(copies), 0)::BIGINT AS files_in_dup_groups FROM groups"
    ),
    "catalog_summary": _after(_summary()),
    "catalog_summary_present": _after(_summary("missing_since IS NULL")),
    "run_counters": _after(f"SELECT {COUNTERS}"),
    "scan_result": _after(
        f"{_summary()} UNION ALL"
        f" (UNPIVOT (SELECT '' AS key, {COUNTERS}) ON COLUMNS(* EXCLUDE key)"
        " INTO NAME metric VALUE value)"
    ),
    "change_report": _sides("SELECT k AS path, change FROM both_sides"),
    "change_counts": _sides("SELECT change, count(*) AS n FROM both_sides GROUP BY change"),
    "catalog_merge": _after(
        "SELECT coalesce(old_id, (SELECT max(id) FROM prior) + row_number() OVER"
        " (PARTITION BY old_id IS NULL ORDER BY substr(md5(path), 1, 4), path))::BIGINT AS id,"
        " path, root, rel_path, top_folder, filename, ext, fmt, category,"
        " rag_eligible::INT AS rag_eligible, size_bytes::BIGINT AS size_bytes, mtime, sha256,"
        " corpus, corpus_hint, run_id, first_seen, last_seen, missing_since, error FROM files"
    ),
    "catalog_merge_reset_corpus": _after("SELECT path, corpus, sha256 FROM files", corpus="reset"),
    "catalog_merge_no_hash": _after("SELECT path, sha256 FROM files", no_hash="keep"),
    "catalog_merge_no_hash_erase": _after("SELECT path, sha256 FROM files", no_hash="erase"),
    "partial_scan": _after(
        "SELECT path, run_id, missing_since FROM files", listing=REACHED, partial=True
    ),
    "missing_count": _sides(
        "SELECT count(*) AS missing, count(*) FILTER (p.missing_since IS NULL) AS newly_missing"
        " FROM both_sides WHERE stale"
    ),
    "mark_missing": _after("SELECT path, missing_since FROM files WHERE missing_since IS NOT NULL"),
    "prune_missing": _after("SELECT path, run_id FROM files", prune=True),
    "reappeared": _sides(
        f"SELECT k AS path, '{THEN}' AS first_seen, NULL::VARCHAR AS missing_since"
        " FROM both_sides WHERE seen AND p.missing_since IS NOT NULL"
    ),
    "run_ledger": _after(
        f"SELECT '{RUN_ID}' AS run_id, '{NOW}' AS started_at, '/lib,/web' AS roots, {COUNTERS}"
    ),
    "schema_upgrade": _named(
        f", {PRIOR} SELECT id::BIGINT AS id, path, sha AS sha256, '{THEN}' AS first_seen,"
        " NULL::VARCHAR AS missing_since FROM prior"
    ),
    "catalog_rows": _after(
        "SELECT path, size_bytes::BIGINT AS size_bytes, sha256 FROM files ORDER BY path"
    ),
    "csv_rows": _after(
        "SELECT path, root, rel_path, top_folder, filename, ext, fmt, category,"
        " rag_eligible::VARCHAR AS rag_eligible, size_bytes::VARCHAR AS size_bytes,"
        f" {SHOWN_MTIME} AS mtime, sha256, corpus, corpus_hint, run_id, first_seen, last_seen,"
        " missing_since, error FROM files ORDER BY path"
    ),
    "moved_files": _after(
        "SELECT g.sha256, g.path AS old_path, count(*) AS new_copies, min(n.path) AS new_path"
        f" FROM files g JOIN files n ON g.sha256 = n.sha256 AND n.first_seen = '{NOW}'"
        " WHERE g.missing_since IS NOT NULL GROUP BY ALL"
    ),
    "folder_callout": _after(
        "SELECT top_folder, count(*) AS files, sum(size_bytes)::BIGINT AS bytes FROM files"
        " WHERE top_folder IN ('15000KindleBooks', 'AudioBooks', 'ComicBookPDFs')"
        " GROUP BY top_folder"
    ),
}
ORACLES["scan_result"] = _after(
    f", counted AS (SELECT {COUNTERS}), gone AS (SELECT count(*) AS missing,"
    " count(*) FILTER (p.missing_since IS NULL) AS newly_missing FROM both_sides WHERE stale)"
    f" {_summary()}"
    + "".join(
        f" UNION ALL SELECT '{c}', '', {c}::BIGINT FROM {t}"
        for t, cs in (
            ("counted", ("files_seen", "files_hashed", "bytes_total", "errors")),
            ("gone", ("missing", "newly_missing")),
        )
        for c in cs
    )
)
