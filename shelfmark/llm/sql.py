"""DuckDB SQL for the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"

_OP1 = f"""
WITH RECURSIVE w AS MATERIALIZED (
    SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents
), s AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2),
             lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM w
), e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id,
    s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c
    ON c.doc_id = s.doc_id
"""

_OP10 = f"""
WITH d AS MATERIALIZED (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents
), b AS MATERIALIZED (
    SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), g AS MATERIALIZED (
    SELECT DISTINCT item_id, least(len(w), 10) AS k,
        unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
            lambda i: array_to_string(w[i:i + 9], ' '))) AS x
    FROM b WHERE len(w) > 0
), places AS MATERIALIZED (
    SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w
    FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k
), hit AS MATERIALIZED (
    SELECT a.doc_id, a.i, a.k, g.item_id
    FROM places a JOIN g ON g.k = a.k AND g.x = array_to_string(a.w[a.i:a.i + a.k - 1], ' ')
), words AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM
        (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
    coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

_OP9 = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d
    FROM pages
), m AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS head FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
    CASE WHEN n >= 1000 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id <> head THEN head END AS refers_to
FROM m
"""

_OP5 = f"""
WITH u AS (
    SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), h AS (
    SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r AS (
    SELECT *, '.' || host AS dotted FROM h
), d AS (
    SELECT *, CASE
        WHEN suffix(dotted, '.example.org') AND prefix(path, '/en/1') THEN 'example.org/en/1'
        WHEN suffix(dotted, '.example.org') AND prefix(path, '/es/') THEN 'example.org/es/'
        WHEN suffix(dotted, '.com') AND prefix(path, '/fr/') THEN 'com/fr/'
        WHEN suffix(dotted, '.com') AND prefix(path, '/de/') THEN 'com/de/'
        WHEN suffix(dotted, '.org') AND prefix(path, '/') THEN 'org/' END AS rule
    FROM r
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*[.])?(adult-|casino-|porn-|spam-|ads-).*([^a-z0-9_.%-]|$)')
      OR regexp_matches(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*[.])?(xxx|cheap-pills|free-bets|ads|tracker|torrent)[.].*([^a-z0-9_.%-]|$)')
      OR regexp_matches(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*[.])?(doubleclick[.]net|bit[.]ly)([^a-z0-9_.%-]|$)')
      OR regexp_matches(lower(url), '/(ads|adserver|banner|wp-admin|cgi-bin|warez|phishing)/|[?&]affiliate=|/wp-login[.]php|[.](exe|apk)$')
    THEN 'block' ELSE 'allow' END AS verdict
FROM d
"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_OP13 = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        {_TERMS} AS w FROM documents
), e AS MATERIALIZED (
    SELECT r, lang, source, term, count(*) AS n
    FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL
), kept AS MATERIALIZED (
    SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM e GROUP BY lang, term HAVING count(*) >= 3
), held AS MATERIALIZED (
    SELECT e.lang, e.source, e.term, CAST(sum(e.n) AS HUGEINT) AS n
    FROM e JOIN kept k ON k.lang = e.lang AND k.term = e.term GROUP BY ALL
), langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(l.n, 0) AS all_n,
        coalesce((SELECT sum(h.n) FROM held h WHERE h.lang = g.lang AND h.source = g.source), 0) AS n
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l ON l.lang = g.lang
), p AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
        1 + (1000000000 * (coalesce(h.n, 0) + 1)) // (g.n + g.v) AS p,
        1 + (1000000000 * (k.n + 1)) // (g.all_n + g.v) AS q
    FROM groups g JOIN kept k ON k.lang = g.lang
    LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
), both_parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM both_parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

# crc32 of bytes b, a bit at a time; the polynomial is 0xEDB88320
_CRC_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

# levenshtein() counts bytes, so letters of two bytes are written as one that words do not hold
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_PLAIN = f"translate(word, '{_ACCENTED}', '{''.join(map(chr, range(0x20, 0x60))).replace(chr(39), chr(39) * 2)}')"

_OP12 = f"""
WITH RECURSIVE bits(i, c, k) AS (
    SELECT i, CAST(i AS BIGINT), 0 FROM range(256) t(i)
    UNION ALL SELECT i, {_CRC_BIT}, k + 1 FROM bits WHERE k < 8
), crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS v FROM bits WHERE k = 8),
runs AS MATERIALIZED (
    SELECT id, run, count(*) AS n FROM (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents
    ) GROUP BY ALL
), hexed AS (SELECT *, hex(encode(id || ':' || run)) AS x FROM runs),
hashed AS MATERIALIZED (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(x) // 2 + 1),
            lambda i: CAST(instr('0123456789ABCDEF', x[2 * i - 1]) - 1 AS BIGINT) * 16 + instr('0123456789ABCDEF', x[2 * i]) - 1)),
        lambda c, b: xor(c >> 8, v[CAST(xor(c, b) & 255 AS INTEGER) + 1]))) AS h
    FROM hexed, crc
), words AS MATERIALIZED (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER))
            || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM hashed
    ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), near AS MATERIALIZED (
    SELECT a.word, b.word AS other, b.n AS other_n
    FROM (SELECT *, {_PLAIN} AS plain, length(word) AS size, unnest([-1, 0, 1]) AS more FROM words) a
    JOIN (SELECT *, {_PLAIN} AS plain, length(word) AS size FROM words) b ON b.size = a.size + a.more
    WHERE levenshtein(a.plain, b.plain) = 1
), best AS (
    SELECT word, count(*) AS n_near, min_by(other, (-other_n, other)) AS other, max(other_n) AS other_n
    FROM near GROUP BY word
), formed AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
        CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
        CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word
), way(word, place, step) AS (
    SELECT word, word, 0 FROM formed
    UNION ALL SELECT way.word, f.form, step + 1 FROM way JOIN formed f ON f.word = way.place WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, max_by(place, step) AS root FROM way GROUP BY word) r ON r.word = f.word
"""

ORACLES = {
    "op5_url_rules": _OP5, "op9_warc": _OP9, "op1_near_dedup": _OP1, "op10_decontamination": _OP10,
    "op12_spelling_variants": _OP12, "op13_source_divergence": _OP13,
}
