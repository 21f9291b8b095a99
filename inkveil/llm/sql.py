"""DuckDB SQL of the queries that SQL can express, over the same tables."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
it AS (
  SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT id, least(len(w), 13) AS k,
    array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
        FROM it WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM iw))),
hits AS (SELECT doc_id, i, k, id FROM dw JOIN iw USING (k, g)),
n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
s AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""

BLANKS = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP7 = f"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT doc_id, pos, line, {LOWER.format(f"trim(line, {BLANKS})")} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (
  SELECT doc_id, pos, line, coalesce(doc_id > first, false) AS gone
  FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP2 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
n AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM r) GROUP BY doc_id),
m AS (
  SELECT doc_id, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN n USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 3 * n_dup_lines > n_lines
    OR 2 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > word_chars
    OR 2 * length(regexp_replace(text, '[^\p{L}]+', '', 'g')) < word_chars) AS kept
FROM m
"""

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
    "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?"
    "([A-Za-z0-9+/_.=-]+)"
)

OP6 = f"""
WITH p AS (
  SELECT * FROM (VALUES (0, 'assign', '{ASSIGN}', 2, 6), (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
    (2, 'hex', '[0-9a-f]+', 0, 24), (3, 'value', '[A-Za-z0-9+/_=-]+', 0, 20))
    AS t(k, kind, pattern, grp, least)),
c AS (
  SELECT doc_id, source, 0 AS k, regexp_extract_all(text, '{ASSIGN}') AS m,
    regexp_extract_all(text, '{ASSIGN}', 2) AS v, string_split_regex(text, '{ASSIGN}') AS g
    FROM documents
  UNION ALL SELECT doc_id, source, 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
    regexp_extract_all(text, 'AKIA[A-Z0-9]+'), string_split_regex(text, 'AKIA[A-Z0-9]+')
    FROM documents
  UNION ALL SELECT doc_id, source, 2, regexp_extract_all(text, '[0-9a-f]+'),
    regexp_extract_all(text, '[0-9a-f]+'), string_split_regex(text, '[0-9a-f]+') FROM documents
  UNION ALL SELECT doc_id, source, 3, regexp_extract_all(text, '[A-Za-z0-9+/_=-]+'),
    regexp_extract_all(text, '[A-Za-z0-9+/_=-]+'), string_split_regex(text, '[A-Za-z0-9+/_=-]+')
    FROM documents),
e AS (
  SELECT doc_id, source, k, i, v[i] AS v, length(m[i]) AS size, length(g[i]) + length(m[i]) AS step
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM c)),
s AS (
  SELECT doc_id, source, k, kind, v, "end" - size AS start, "end"
  FROM (SELECT *, sum(step) OVER (PARTITION BY doc_id, k ORDER BY i) AS "end" FROM e)
  JOIN p USING (k) WHERE length(v) >= least),
o AS (SELECT v, count(DISTINCT source) AS owners FROM s GROUP BY v),
r AS (
  SELECT s.*, owners = 1 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
      AND len(list_distinct(string_split(v, ''))) >= 8 AS live, owners >= 3 AS example,
    EXISTS (SELECT 1 FROM s AS b WHERE b.doc_id = s.doc_id AND b.k < 3
      AND b.start < s."end" AND s.start < b."end") AS over
  FROM s JOIN o USING (v)),
f AS (SELECT * FROM r WHERE k < 3 OR (live AND NOT over)),
a AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
    count(*) FILTER (k = 2) AS n_hex, count(*) FILTER (live) AS n_live,
    count(*) FILTER (example) AS n_example,
    string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT), ','
      ORDER BY start, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST("end" AS BIGINT), ','
      ORDER BY start, k) AS spans
  FROM f GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents LEFT JOIN a USING (doc_id)
"""
