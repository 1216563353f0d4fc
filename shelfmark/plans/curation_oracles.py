"""DuckDB SQL of the queries in ``curation``, with windows where those aggregate and join."""

from shelfmark.plans.oracles import FOLDERS, SUFFIX, _after

_PATH = f"'/lib/' || {FOLDERS} || source || '_' || doc_id || {SUFFIX}"
_RANK = "(CASE WHEN fmt = 'epub' THEN 0 WHEN fmt IN ('mobi', 'azw3') THEN 1 WHEN fmt = 'pdf' THEN 2 ELSE 3 END)"


def _recursive(query: str) -> str:
    return _after(query).replace("WITH", "WITH RECURSIVE", 1)


def _norm(column: str) -> str:
    folded = (
        f"translate(lower({column}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy')"
    )
    return f"trim(regexp_replace({folded}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


_ASSIGNED = """
  , given AS (SELECT sha, min(c) AS given, min(c) <> max(c) AS split FROM (
                SELECT sha, CASE WHEN quality = 0 THEN 'untrusted-nonfiction'
                                 WHEN toxic = 1 THEN 'fiction'
                                 WHEN toxic = 0 THEN 'trusted-nonfiction' END AS c
                FROM docs JOIN labels USING (doc_id)) WHERE c IS NOT NULL GROUP BY sha),
  assigned AS (SELECT files.* REPLACE (CASE WHEN split OR given IS NULL THEN coalesce(corpus, 'unassigned') ELSE given END AS corpus),
                      coalesce(split, false) AS split
               FROM files LEFT JOIN given ON sha256 = sha)"""

_TITLED = f"""{_ASSIGNED},
  texts AS (SELECT {_PATH} AS path, text, n_chars, doc_id,
                     source || ' - Étude No. ' || (n_chars // 100) AS name FROM documents),
  named AS (SELECT f.*, coalesce(name, CASE WHEN strpos(substr(filename, 2), '.') > 0
                   THEN left(filename, length(filename) - 1 - length(split_part(filename, '.', -1)))
                   ELSE filename END) AS name
            FROM assigned f LEFT JOIN texts USING (path)),
  parts AS (SELECT *, CASE WHEN corpus = 'unassigned' THEN corpus_hint ELSE corpus END AS shelf, CASE WHEN strpos(name, ' - ') > 0 THEN left(name, strpos(name, ' - ') - 1)
                           ELSE '' END AS author,
                   CASE WHEN strpos(name, ' - ') > 0 THEN substr(name, strpos(name, ' - ') + 3)
                        ELSE name END AS title FROM named),
  titled AS (SELECT *, {_norm('author')} AS author_key, {_norm('title')} AS title_key FROM parts)"""

_DECIDED = f"""{_TITLED},
  kept AS (SELECT *, CASE WHEN sha256 IS NOT NULL AND count(*) OVER w > 1
                     THEN first_value(path) OVER (w ORDER BY missing_since IS NOT NULL, {_RANK},
                                                  first_seen, path) END AS keeper
           FROM titled WINDOW w AS (PARTITION BY sha256, shelf)),
  live AS (SELECT *, missing_since IS NULL AND rag_eligible = 1
                     AND (keeper IS NULL OR keeper = path) AS live FROM kept),
  best AS (SELECT *, first_value(path) OVER (t ORDER BY {_RANK}, path) AS canonical,
                  min({_RANK}) OVER t AS best, max({_RANK}) OVER t AS worst
           FROM live WINDOW t AS (PARTITION BY live, shelf, author_key, title_key)),
  decided AS (SELECT *, CASE WHEN path <> keeper THEN 'drop'
                             WHEN live AND {_RANK} > best THEN 'review' ELSE 'keep' END AS decision
              FROM best)"""

_LAYOUT = f"""{_DECIDED},
  wanted AS (SELECT path, root,
               CASE WHEN rag_eligible = 1 AND corpus = 'unassigned' THEN 'review' ELSE decision END AS decision,
               CASE WHEN rag_eligible = 1 AND corpus = 'unassigned' THEN path WHEN rag_eligible = 1
               THEN '/library/' || corpus || '/' || CASE author_key WHEN '' THEN 'unknown' ELSE author_key END
                 || '/' || t || '/' || t || '.' || ext
               ELSE '/library/_non_rag' || path END AS target
             FROM (SELECT *, CASE title_key WHEN '' THEN 'untitled' ELSE title_key END AS t FROM decided)
             WHERE missing_since IS NULL AND decision <> 'drop'),
  claimed AS (SELECT target AS place FROM wanted UNION ALL
              SELECT path FROM files WHERE missing_since IS NULL
                AND path NOT IN (SELECT path FROM wanted WHERE path = target)),
  layout AS (SELECT *, (SELECT count(*) FROM claimed WHERE place = target) AS claims FROM wanted),
  acts AS (SELECT *, CASE WHEN decision = 'review' THEN 'review' WHEN path = target THEN 'stay'
                          WHEN claims > 1 THEN 'conflict' ELSE 'move' END AS action FROM layout),
  moves AS (SELECT *, CASE WHEN action = 'move' THEN target END AS dst FROM acts)"""

# Chapters by lines: a heading numbers those after it, and a chapter is its lines put together.
_CHUNKS = f"""{_DECIDED},
  lined AS (SELECT d.* EXCLUDE (title), title AS book, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS line_no
            FROM decided d JOIN texts USING (path)
            WHERE live AND decision = 'keep' AND corpus <> 'unassigned' AND text <> ''),
  numbered AS (SELECT *, coalesce(sum(CASE WHEN head THEN 1 END) OVER (
                             PARTITION BY path ORDER BY line_no ROWS UNBOUNDED PRECEDING)
                           - max(CASE WHEN line_no = 1 AND head THEN 1 ELSE 0 END) OVER (PARTITION BY path), 0) AS chapter_no,
                      max(line_no) OVER (PARTITION BY path) AS lines
               FROM (SELECT *, regexp_full_match(line, '\\S[^\\n]{{0,23}}[ \\t\\r]*') AS head FROM lined)),
  chapters AS (SELECT path, sha256, corpus, author, book, chapter_no::INTEGER AS chapter_no,
                      nullif(trim(min(line) FILTER (head), '# ' || chr(9) || chr(13)), '') AS chapter,
                      string_agg(line, chr(10) ORDER BY line_no)
                        || CASE WHEN max(line_no) < max(lines) THEN chr(10) ELSE '' END AS body
               FROM numbered GROUP BY ALL),
  passages AS (SELECT path, sha256, corpus, author, book, chapter_no, chapter, i::INTEGER AS chunk_no,
                      (i * 1000)::BIGINT AS location, substr(body, i * 1000 + 1, 1000) AS chunk
               FROM (SELECT *, unnest(range(0, (length(body) + 999) // 1000)) AS i FROM chapters))"""

# The cutting rule in whole numbers: a place ends a passage where the sum of the last 16 code
# points times powers of 257, modulo 1000003, is a multiple of 512; passages have 256 to 4096.
_POWERS = [pow(257, j, 1_000_003) for j in range(16)]
_CUT = f"""{_DECIDED},
  cited AS MATERIALIZED (SELECT path, corpus, doc_id, text FROM decided JOIN texts USING (path)
                         WHERE live AND decision = 'keep' AND corpus <> 'unassigned'),
  versions AS MATERIALIZED (SELECT path, corpus, doc_id, 0 AS version, text FROM cited
                            UNION ALL SELECT path, corpus, doc_id, 1, substr(text, 101) FROM cited),
  coded AS MATERIALIZED (SELECT doc_id, version, length(text) AS n,
                                list_transform(string_split(text, ''), lambda c: unicode(c)::BIGINT) AS cp
                         FROM versions WHERE length(text) > 0),
  placed AS MATERIALIZED (SELECT doc_id, version, n, list_filter(range(1, n + 1), lambda i:
        list_sum(list_transform(range(0, least(16, i)), lambda j: cp[i - j] * ({_POWERS})[j + 1]))
        % 1000003 % 512 = 0) AS places FROM coded),
  cuts(doc_id, version, n, places, no, b, e) AS (
    SELECT doc_id, version, n, places, 0, 1::BIGINT, least(n, 4096,
           coalesce(list_min(list_filter(places, lambda x: x >= 256)), n)) FROM placed
    UNION ALL
    SELECT doc_id, version, n, places, no + 1, e + 1, least(n, e + 4096,
           coalesce(list_min(list_filter(places, lambda x: x >= e + 256)), n)) FROM cuts WHERE e < n)"""

_NEAR = (_DECIDED.replace(
    "source || ' - Étude No. '",
    "source || ' - ' || CASE WHEN lang = 'fr' THEN 'Études' WHEN lang = 'de' THEN 'Etuden'"
    " WHEN lang = 'es' THEN 'Estude' ELSE 'Étude' END || ' No. '",
) + """,
  spelled AS MATERIALIZED (SELECT path, shelf, trim(author_key || ' ' || title_key) AS name,
            length(bin(size_bytes)) AS band FROM decided WHERE live),
  nodes AS MATERIALIZED (SELECT shelf, name, band, min(path) AS node, count(*) AS files,
            array_to_string(regexp_extract_all(name, '[0-9]+'), ' ') AS digits FROM spelled GROUP BY shelf, name, band),
  linked AS MATERIALIZED (SELECT a.node AS a, b.node AS b FROM nodes a JOIN nodes b
            ON a.shelf = b.shelf AND a.digits = b.digits AND a.node <> b.node AND abs(a.band - b.band) <= 1
            AND (a.name = b.name OR (least(length(a.name), length(b.name)) >= 5 AND levenshtein(a.name, b.name) <= 1))),
  reach(node, other) AS (SELECT node, node FROM nodes
            UNION SELECT reach.node, l.b FROM reach JOIN linked l ON l.a = reach.other),
  roots AS (SELECT node, min(other) AS keeper FROM reach GROUP BY node),
  sizes AS (SELECT keeper, sum(files)::BIGINT AS files FROM roots JOIN nodes USING (node) GROUP BY keeper)
  SELECT path, keeper, s.files, (SELECT count(*) FROM linked WHERE a = nodes.node) AS links
  FROM spelled JOIN nodes USING (shelf, name, band) JOIN roots USING (node) JOIN sizes s USING (keeper)
  WHERE s.files > 1""")

# Numbers are cut out of the imprint by place, not by search, and compared as their first nine digits.
_DIGITS = "list_transform(range(1, {n}), lambda i: substr({body}, i, 1)::INTEGER * {weight})"
_TEN = "list_sum(" + _DIGITS.format(n=10, body="body", weight="(11 - i)") + ")"
_THIRTEEN = "list_sum(" + _DIGITS.format(n=10, body="body", weight="CASE i % 2 WHEN 1 THEN 3 ELSE 1 END") + ") + 38"
_RECONCILED = (
    _DECIDED.replace("(n_chars // 100)", "(n_chars // 10)").replace(
        "FROM assigned f", "FROM (SELECT * REPLACE (coalesce(corpus, 'unassigned') AS corpus) FROM files) f"
    ) + f""",
  checked AS (SELECT doc_id, lpad(n_chars::VARCHAR, 9, '0') AS body, ({_THIRTEEN}) % 10 AS rest,
                     CASE WHEN lang = 'de' THEN ({_TEN} + doc_id % 11) % 11 = 0
                          ELSE ({_THIRTEEN} + doc_id % 10) % 10 = 0 END AS right_digit FROM documents),
  numbers AS (SELECT doc_id, CASE WHEN right_digit THEN '978' || body || ((10 - rest) % 10) END AS isbn
              FROM checked),
  disk AS MATERIALIZED (SELECT path, sha256, isbn, author_key, title_key, corpus FROM decided
           LEFT JOIN texts USING (path) LEFT JOIN numbers USING (doc_id) WHERE live),
  sheet AS MATERIALIZED (SELECT 'L' || doc_id AS entry_id, isbn, CASE WHEN toxic = 1 THEN '' ELSE source END AS a,
                   CASE WHEN quality = 0 THEN 'notes ' ELSE 'etude no ' END || (n_chars // 10) AS t,
                   CASE WHEN quality = 0 THEN 'untrusted-nonfiction' WHEN toxic = 1 THEN 'fiction'
                        WHEN toxic = 0 THEN 'trusted-nonfiction' END AS c
            FROM documents JOIN labels USING (doc_id) JOIN numbers USING (doc_id)
            UNION ALL SELECT 'B' || item_id, NULL, 'item', 'reference ' || item_id, 'trusted-nonfiction'
            FROM benchmark),
  meets AS MATERIALIZED (SELECT path, entry_id, CASE WHEN d.isbn = s.isbn THEN 1
                  WHEN author_key = a AND a <> '' THEN 2 ELSE 3 END AS strength
            FROM disk d JOIN sheet s ON d.isbn = s.isbn OR (title_key = t AND t <> ''
                 AND (author_key = a OR author_key = '' OR a = ''))),
  chosen AS MATERIALIZED (SELECT * FROM meets QUALIFY strength = min(strength) OVER (PARTITION BY path)),
  counted AS MATERIALIZED (SELECT path, min(entry_id) AS entry_id, count(*) AS candidates, min(strength) AS strength
              FROM chosen GROUP BY path),
  tied AS MATERIALIZED (SELECT DISTINCT x.entry_id AS a, y.entry_id AS b FROM chosen x JOIN counted y USING (path)),
  bonds AS MATERIALIZED (SELECT a, b FROM tied UNION SELECT b, a FROM tied),
  reach(entry_id, other) AS (SELECT entry_id, entry_id FROM sheet
            UNION SELECT reach.entry_id, b FROM reach JOIN bonds ON a = other),
  roots AS MATERIALIZED (SELECT entry_id, min(other) AS group_id, count(*) AS group_entries FROM reach GROUP BY entry_id),
  compared AS (SELECT path, sha256, strength, n.entry_id, coalesce(candidates, 0) AS candidates, c,
      CASE WHEN candidates = 1 THEN nullif(concat_ws(',', CASE WHEN d.isbn <> s.isbn THEN 'isbn' END,
          CASE WHEN author_key <> '' AND a <> '' AND author_key <> a THEN 'author' END,
          CASE WHEN title_key <> '' AND t <> '' AND title_key <> t THEN 'title' END,
          CASE WHEN d.corpus <> 'unassigned' AND d.corpus <> c THEN 'corpus' END), '') END AS differs
      FROM disk d LEFT JOIN counted n USING (path) LEFT JOIN sheet s ON s.entry_id = n.entry_id),
  judged AS MATERIALIZED (SELECT *, CASE WHEN candidates = 0 THEN 'disk_only' WHEN candidates > 1 THEN 'conflict'
                       WHEN differs IS NULL THEN 'matched' ELSE 'mismatch' END AS status FROM compared),
  lines AS MATERIALIZED (SELECT s.entry_id, group_id, group_entries, count(path) AS files,
                   CASE WHEN bool_or(status = 'matched') THEN 'matched' WHEN bool_or(status = 'mismatch')
                   THEN 'mismatch' WHEN count(path) > 0 THEN 'conflict' ELSE 'ledger_only' END AS status
            FROM sheet s JOIN roots USING (entry_id) LEFT JOIN chosen USING (entry_id)
            LEFT JOIN (SELECT path, status FROM judged) USING (path) GROUP BY ALL)"""
)

ORACLES = {
    "normalize_title": _after(f"{_TITLED} SELECT path, author, title, author_key, title_key FROM titled"),
    "dedup_exact": _after(
        f"{_DECIDED} SELECT path, sha256, shelf AS corpus, keeper, CASE WHEN path = keeper THEN 'keep'"
        " ELSE 'drop' END AS decision FROM decided WHERE keeper IS NOT NULL"
    ),
    "dedup_format": _after(
        f"{_DECIDED} SELECT path, fmt, canonical, decision FROM decided WHERE live AND best < worst"
    ),
    "dedup_decisions": _after(
        f"{_DECIDED} SELECT path, decision, CASE decision WHEN 'drop' THEN 'exact_copy'"
        " WHEN 'review' THEN 'other_format' END AS reason FROM decided"
    ),
    "canonical_titles": _after(
        f"{_DECIDED} SELECT shelf AS corpus, author_key, title_key, any_value(canonical) AS canonical,"
        " count(*) AS files FROM decided WHERE live GROUP BY ALL"
    ),
    "assign_corpus": _after(f"{_ASSIGNED} SELECT path, corpus FROM assigned"),
    "corpus_review": _after(
        f"{_ASSIGNED} SELECT path, corpus, corpus_hint, CASE WHEN split THEN 'ambiguous'"
        " WHEN corpus = 'unassigned' THEN 'unassigned' ELSE 'hint_differs' END AS reason"
        " FROM assigned WHERE missing_since IS NULL AND (split OR corpus = 'unassigned'"
        " OR (corpus_hint <> 'unassigned' AND corpus_hint <> corpus))"
    ),
    "layout_plan": _after(f"{_LAYOUT} SELECT path, target, claims FROM layout"),
    "move_manifest": _after(
        f"{_LAYOUT} SELECT path AS src, dst, action, dst AS inverse_src,"
        " CASE WHEN action = 'move' THEN path END AS inverse_dst FROM moves"
    ),
    "apply_manifest": _after(
        f"{_LAYOUT} SELECT coalesce(dst, f.path) AS path,"
        " CASE WHEN dst IS NULL THEN f.root ELSE '/library' END AS root,"
        " CASE WHEN dst IS NULL THEN rel_path ELSE substr(dst, 10) END AS rel_path,"
        " CASE WHEN dst IS NULL THEN top_folder ELSE split_part(dst, '/', 3) END AS top_folder,"
        " CASE WHEN dst IS NULL THEN filename ELSE split_part(dst, '/', -1) END AS filename,"
        " sha256 FROM files f LEFT JOIN moves m ON f.path = m.path"
    ),
    # every chain is walked move by move
    "ordered_moves": """WITH RECURSIVE
      volumes AS MATERIALIZED (SELECT '/lib/vol_' || doc_id AS p, '/lib/vol_' || CASE lang WHEN 'fr' THEN doc_id
                  WHEN 'de' THEN xor(doc_id, 1) ELSE doc_id + 1 END AS t FROM documents),
      told AS MATERIALIZED (SELECT *, CASE WHEN p = t THEN 'stay' WHEN count(*) OVER (PARTITION BY t) > 1
                  THEN 'claimed' ELSE 'move' END AS action FROM volumes),
      going AS MATERIALIZED (SELECT p, t FROM told WHERE action = 'move'),
      walk(p, lies, n) AS (SELECT p, t, 0 FROM going UNION ALL
                  SELECT w.p, g.t, n + 1 FROM walk w JOIN going g ON g.p = w.lies WHERE w.lies <> w.p),
      ends AS MATERIALIZED (SELECT p, arg_max(lies, n) AS e, max(n)::BIGINT AS n, min(lies) AS root FROM walk GROUP BY p),
      kinds AS (SELECT *, e = p AS ring, e <> p AND e IN (SELECT p FROM volumes) AS stuck FROM ends),
      timed AS (SELECT k.*, t, CASE WHEN NOT ring THEN k.n WHEN k.p = root THEN 0 ELSE w.n + 1 END::BIGINT AS step,
                       CASE WHEN ring THEN k.n + 1 ELSE max(k.n) OVER (PARTITION BY ring, e) END::BIGINT AS last_step
                FROM kinds k JOIN going USING (p) LEFT JOIN walk w ON ring AND w.p = k.p AND w.lies = root
                WHERE NOT stuck),
      named AS (SELECT *, p || '.aside-' || sha256(p) AS aside, ring AND p = root AS first FROM timed)
      SELECT p AS path, p AS src, CASE WHEN first THEN aside ELSE t END AS dst, step, last_step,
             CASE WHEN first THEN 'aside' ELSE 'move' END AS action FROM named
      UNION ALL SELECT p, aside, t, last_step, last_step, 'back' FROM named WHERE first
      UNION ALL SELECT p, p, NULL, NULL, NULL, 'occupied' FROM kinds WHERE stuck
      UNION ALL SELECT p, p, NULL, NULL, NULL, action FROM told WHERE action <> 'move'""",
    "conversion_worklist": _after(
        f"{_DECIDED} SELECT path, sha256, fmt, fmt = 'pdf' AND NOT EXISTS (SELECT 1 FROM texts t"
        " JOIN files f USING (path) WHERE f.sha256 = d.sha256 AND n_chars > 0) AS ocr"
        " FROM decided d WHERE live AND decision = 'keep' AND fmt <> 'epub' AND NOT EXISTS"
        " (SELECT 1 FROM docs JOIN labels USING (doc_id) WHERE quality = 1 AND sha = d.sha256)"
    ),
    "conversion_status": _after(
        f"{_DECIDED}, tries AS (SELECT sha, 1 AS batch, doc_id AS done, quality = 1 AS good,"
        " 'exit ' || quality AS error FROM docs JOIN labels USING (doc_id) WHERE quality IN (0, 1)"
        " UNION ALL SELECT sha, 2, 5000000, toxic IS DISTINCT FROM 1, unnest(CASE WHEN toxic = 1"
        " THEN ['timeout', 'password'] ELSE ['none'] END) FROM docs JOIN labels USING (doc_id) WHERE quality = 0),"
        " state AS (SELECT DISTINCT ON (sha) sha, good, error, count(*) OVER (PARTITION BY sha) AS n FROM tries"
        " ORDER BY sha, done DESC, good DESC, error DESC)"
        " SELECT path, sha256, fmt, CASE WHEN good THEN 'converted' WHEN NOT good THEN 'failed' ELSE 'pending' END"
        " AS status, coalesce(n, 0) AS attempts, CASE WHEN NOT good THEN state.error END AS error,"
        " CASE WHEN good THEN '/library/_converted/' || sha256 || '.epub' END AS target"
        " FROM decided LEFT JOIN state ON sha256 = sha WHERE live AND decision = 'keep' AND fmt <> 'epub'"
    ),
    "citation_chunks": _after(f"{_CHUNKS} SELECT * FROM passages"),
    "content_chunks": _recursive(
        f"{_CUT} SELECT path, corpus, no::INTEGER AS chunk_no, (b - 1)::BIGINT AS location,"
        " (e - b + 1)::BIGINT AS n_chars, sha256(substr(text, b, e - b + 1)) AS chunk_key"
        " FROM cuts JOIN cited USING (doc_id) WHERE version = 0"
    ),
    "embed_worklist": _recursive(
        f"{_CUT}, keyed AS (SELECT corpus, sha256(substr(text, b, e - b + 1)) AS chunk_key, version,"
        " e - b + 1 AS n, path, doc_id FROM cuts JOIN versions USING (doc_id, version))"
        " SELECT corpus, chunk_key, any_value(n)::BIGINT AS n_chars, min(path) AS path FROM keyed k"
        " WHERE version = 0 AND NOT EXISTS (SELECT 1 FROM keyed o JOIN labels USING (doc_id)"
        " WHERE quality = 1 AND o.version = 1 AND o.corpus = k.corpus AND o.chunk_key = k.chunk_key)"
        " GROUP BY corpus, chunk_key"
    ),
    "dedup_near": _recursive(_NEAR),
    "reconcile_match": _recursive(
        f"{_RECONCILED} SELECT path, (['isbn', 'author_title', 'title'])[strength] AS matched_by, j.entry_id,"
        " candidates, group_id, group_entries, differs, status, CASE WHEN candidates = 1 THEN c END"
        " AS ledger_corpus FROM judged j LEFT JOIN roots r ON r.entry_id = j.entry_id"
    ),
    "reconcile_entries": _recursive(
        f"{_RECONCILED} SELECT entry_id, status, files, group_id, group_entries FROM lines"
    ),
    "reconcile_report": _recursive(
        f"{_RECONCILED} SELECT status, coalesce(n, 0) AS files, coalesce(m, 0) AS entries,"
        " coalesce(g, 0) AS open_groups FROM (SELECT status, count(*) AS n FROM judged GROUP BY status)"
        " FULL JOIN (SELECT status, count(*) AS m, count(DISTINCT CASE WHEN group_entries > 1 THEN group_id END)"
        " AS g FROM lines GROUP BY status) USING (status)"
    ),
    "ledger_corpus": _recursive(
        f"{_RECONCILED}, told AS (SELECT sha256, min(c) AS c, min(c) <> max(c) AS split FROM judged"
        " WHERE candidates = 1 AND c IS NOT NULL GROUP BY sha256)"
        " SELECT path, CASE WHEN split OR c IS NULL THEN coalesce(corpus, 'unassigned') ELSE c END AS corpus,"
        " coalesce(split, false) AS ambiguous FROM files LEFT JOIN told USING (sha256)"
    ),
    "retrieve_topk": _after(
        f"{_DECIDED}, cited AS (SELECT path, corpus, author, title AS book, doc_id AS id FROM decided"
        " JOIN texts USING (path) WHERE live AND decision = 'keep' AND corpus <> 'unassigned'),"
        " vectors AS MATERIALIZED (SELECT vec_id AS id, list_transform(embedding, lambda x:"
        " floor(x::DOUBLE * 10000 + 0.5)::BIGINT) AS v FROM embeddings),"
        " scored AS (SELECT q.id AS query_id, c.*, list_sum(list_transform(range(1, len(q.v) + 1),"
        " lambda i: q.v[i] * p.v[i]))::BIGINT AS score"
        " FROM vectors q, vectors p JOIN cited c USING (id) WHERE q.id % 50 = 0),"
        " ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id, corpus ORDER BY score DESC, id)"
        "::INTEGER AS rank FROM scored)"
        " SELECT query_id, corpus, rank, id, score, path, author, book FROM ranked WHERE rank <= 5"
    ),
    "collection_sizes": _after(
        f"{_CHUNKS} SELECT corpus, count(*) FILTER (chapter_no = 0 AND chunk_no = 0) AS files, count(*) AS chunks,"
        " sum(length(chunk))::BIGINT AS chars FROM passages GROUP BY corpus"
    ),
    "collection_changes": _after(f"""{_DECIDED},
      wanted AS (SELECT path, sha256, corpus, author, title AS book FROM decided
                 WHERE live AND decision = 'keep' AND corpus <> 'unassigned'),
      held AS (SELECT docs.path, CASE lang WHEN 'de' THEN 'stale' ELSE sha END AS sha,
                      CASE WHEN n_chars % 2 = 1 THEN source ELSE '' END AS author,
                      'Étude No. ' || (n_chars // 100) AS book
               FROM docs JOIN (SELECT doc_id, source, n_chars FROM documents) USING (doc_id)
               LEFT JOIN labels USING (doc_id) WHERE lang = 'es' OR toxic = 0)
      SELECT path, CASE WHEN h.path IS NULL THEN 'insert' WHEN w.path IS NULL THEN 'delete'
                        WHEN sha256 IS NULL OR sha <> sha256 THEN 'change'
                        WHEN corpus <> 'trusted-nonfiction' THEN 'move' ELSE 'retitle' END AS op,
             CASE WHEN h.path IS NOT NULL THEN 'trusted-nonfiction' END AS from_corpus, corpus AS to_corpus
      FROM held h FULL JOIN wanted w USING (path)
      WHERE NOT coalesce(sha = sha256 AND corpus = 'trusted-nonfiction' AND h.author = w.author
                         AND h.book = w.book, false)"""),
    "synced_collections": _after(f"{_CHUNKS} SELECT * FROM passages"),
}
