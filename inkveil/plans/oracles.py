"""SQL twins of the queries.

They are written from the meaning of the query, not from its Spark plan: the texts of
notes and transcripts are put together from columns, so the oracle reads the nominatives
and their offsets off the columns instead of searching for them.
"""

from __future__ import annotations

# --- fixed values, on their own on this side; a test compares them -----------------------
LETTERS = (
    "A-Za-zÀ-ÖØ-öø-ÿ"
    "ĿŀČčŘřŠšŽžĲĳŒœŸŐőŰűḂḃĊċḊḋḞḟĠġṀṁṠṡṪṫĀāĒēĪīŌōŪūİıĞğŞşẀẁẂẃŴŵŶŷǾǿẞ"
)
APOSTROPHES = "'‘’′´`"
PARTICLES = (
    "d((a|e)(l(l[aeo]?)?|i|gli?)?|i)?|(ne|a|su)(l(l[aeo]?)?|i|gli)?"
    "|l[aeo]?|co[iln]?|i[ln]?|gli|per"
)
DEFAULT_KEEP_EXPRESSIONS = (
    "Al Sindaco",
    "Il Sindaco",
    "Il Sottoscritto",
    "La Sottoscritta",
    "Al Sottoscritto",
    "Alla Sottoscritta",
)
DOCUMENT_PEOPLE = (
    "Stteen;Erachtz",
    "General;Public",
    "Apache;License",
    "Und;Und",
    "Orre;Orre",
)
DOCUMENT_KEEP = ("Apache License", "Of Of")
SALT = 20260
# -----------------------------------------------------------------------------------------

_L = LETTERS
_APOS = APOSTROPHES.replace("'", "''")
_NON_ASCII = LETTERS.replace("A-Za-z", "")
_NAME = f"[A-Z][{_L}]+"
_SURNAME = f"(([A-Z][{_L}]*|(?i:{PARTICLES}))[{_APOS}\\s]+)?{_NAME}"
_GATE = (
    f"(^|[^{_L}])((({_NAME}\\s+)?{_NAME}\\s+{_SURNAME})"
    f"|({_SURNAME}\\s+{_NAME}(\\s+{_NAME})?))([^{_L}]|$)"
)


def _cap(word: str) -> str:
    return f"(upper(substr({word}, 1, 1)) || lower(substr({word}, 2)))"


_FIRST = _cap("split_part(p_name, ' ', 1)")
_LAST = _cap("split_part(p_name, ' ', 2)")
_KIND = _cap("p_type")

_LINES = """
lines AS (
  SELECT doc_id, lang, source, CAST(i - 1 AS INTEGER) AS block_idx, parts[i] AS text
  FROM (
    SELECT doc_id, lang, source, parts, unnest(range(1, len(parts) + 1)) AS i
    FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS parts FROM documents)
  )
)"""

# letters outside ASCII become a letter and digits a mark, so \b is the end of a word
_PLAIN_LINES = f"""
plain AS (
  SELECT doc_id, block_idx, text,
    regexp_replace(regexp_replace(text, '[{_NON_ASCII}]', 'q', 'g'), '[0-9_]', '#', 'g') AS t
  FROM lines WHERE regexp_matches(text, '{_GATE}')
)"""


def _ci(term: str) -> str:
    return f"{term[0]}(?i:{term[1:]})"


def _document_patterns() -> str:
    rows = []
    for number, line in enumerate(DOCUMENT_PEOPLE, 1):
        name, surname = (_ci(t) for t in line.split(";"))
        pattern = f"\\b(?:{name}\\s+{surname}|{surname}\\s+{name})\\b"
        rows.append(f"({number}, '{line.split(';')[0]}', '{pattern}')")
    return ", ".join(rows)


def _document_keeps() -> str:
    both = {x for e in DOCUMENT_KEEP + DEFAULT_KEEP_EXPRESSIONS for x in (e, e.upper())}
    return ", ".join(f"('{e}')" for e in sorted(both))


_DOCUMENT_SPANS = f"""
{_LINES}, {_PLAIN_LINES},
person(entry_id, plain_name, pattern) AS (VALUES {_document_patterns()}),
keep(expr) AS (VALUES {_document_keeps()}),
hit AS (
  SELECT doc_id, block_idx, text, entry_id, plain_name,
    regexp_extract_all(t, pattern) AS h, string_split_regex(t, pattern) AS g
  FROM plain, person WHERE regexp_matches(t, pattern)
),
placed AS (
  SELECT *, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0) AS INTEGER) AS b
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM hit)
),
spans AS (
  SELECT doc_id, block_idx, text, entry_id, plain_name, b AS start,
    CAST(b + length(h[i]) AS INTEGER) AS stop
  FROM placed
),
kept AS (
  SELECT doc_id, block_idx, p AS k_start, p + length(expr) AS k_stop
  FROM (
    SELECT doc_id, block_idx, text, expr, unnest(range(0, length(text))) AS p
    FROM plain, keep WHERE contains(text, expr)
  ) WHERE substr(text, p + 1, length(expr)) = expr
),
judged AS (
  SELECT s.*, CASE WHEN EXISTS (
    SELECT 1 FROM kept k WHERE k.doc_id = s.doc_id AND k.block_idx = s.block_idx
      AND k_start < s.stop AND s.start < k_stop
  ) THEN 'protected' ELSE 'replaced' END AS status
  FROM spans s
)"""

# --- the people list --------------------------------------------------------------------

_LIST_LINES = f"""
list_line AS (
  SELECT row_number() OVER (ORDER BY line) AS line_no, line FROM (
    SELECT CASE
      WHEN p_type = 'ECONOMY' AND p_size > 25
        THEN {_FIRST} || ':' || {_KIND} || ':Senior;' || {_LAST}
      WHEN p_type IN ('ECONOMY', 'PROMO') THEN {_FIRST} || ':' || {_KIND} || ';' || {_LAST}
      WHEN p_type = 'STANDARD' THEN {_FIRST} || ';' || {_LAST}
      WHEN p_type = 'MEDIUM' AND starts_with(p_name, 'blue')
        THEN '!' || {_FIRST} || ';' || {_LAST}
      WHEN p_type = 'SMALL' THEN {_FIRST} || ' ' || {_LAST}
      ELSE {_FIRST} || ';de ' || {_LAST} END AS line
    FROM part
    UNION
    SELECT CASE WHEN contains(r_name, ' ')
      THEN 'Middle East:' || 'middlE' || ' easT' || ';' || 'Tsae Elddim'
      ELSE {_cap('r_name')} || ':' || reverse({_cap('reverse(r_name)')}) || ';'
        || {_cap('reverse(r_name)')} END
    FROM region
  )
),
checked AS (
  SELECT line_no, line,
    regexp_full_match(line, '!?([{_L}{_APOS}]+:){{0,9}}[{_L}{_APOS}]+;[{_L}{_APOS}\\s]+')
      AS is_valid
  FROM list_line
),
people AS (
  SELECT row_number() OVER (PARTITION BY keep ORDER BY line_no) AS person_id,
    string_split(split_part(body, ';', 1), ':') AS names,
    split_part(body, ';', 2) AS surname, keep
  FROM (
    SELECT line_no, starts_with(line, '!') AS keep, ltrim(line, '!') AS body
    FROM checked WHERE is_valid
  )
),
term AS (
  SELECT DISTINCT person_id, upper(t) AS t FROM (
    SELECT person_id, unnest(list_append(names, surname)) AS t FROM people WHERE NOT keep
  )
),
marked AS (
  SELECT p.*, NOT p.keep AND EXISTS (
    SELECT 1 FROM term a JOIN term b ON a.t = b.t AND a.person_id <> b.person_id
    WHERE a.person_id = p.person_id
  ) AS has_homonym
  FROM people p
)"""

_CHOICES = """
choice AS (
  SELECT person_id, len(names) AS n, names, surname, has_homonym, [i] AS path
  FROM (SELECT *, unnest(range(1, len(names) + 1)) AS i FROM marked WHERE NOT keep)
  UNION ALL
  SELECT person_id, n, names, surname, has_homonym, list_append(path, i) FROM (
    SELECT *, unnest(range(1, n + 1)) AS i FROM choice
  ) WHERE NOT list_contains(path, i)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY len(path) DESC, path) AS rank
  FROM choice
)"""

# --- notes ------------------------------------------------------------------------------

_NOTES = f"""
note AS (
  SELECT note_id, l_orderkey, kind, f, l, k, qty, said,
    'Order ' || l_orderkey || ': ' AS head,
    'Order ' || l_orderkey || ': ' || said || ' took ' || qty || ', ' || said || '.' AS text
  FROM (
    SELECT *, CASE kind
      WHEN 0 THEN f || ' ' || l WHEN 1 THEN l || ' ' || f WHEN 2 THEN f || ' ' || upper(l)
      WHEN 3 THEN f || ' ' || k || ' ' || l WHEN 4 THEN lower(f) || ' ' || l
      WHEN 5 THEN 'Al Sindaco ' || f || '  ' || l ELSE f || ' De ' || l END AS said
    FROM (
      SELECT l_orderkey, l_linenumber % 7 AS kind, CAST(l_quantity AS INTEGER) AS qty,
        {_FIRST} AS f, {_LAST} AS l, {_KIND} AS k,
        concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
          CAST(l_quantity AS INTEGER)) AS note_id
      FROM lineitem JOIN part ON l_partkey = p_partkey
    )
  )
),
place AS (
  SELECT *, length(head) AS spot FROM note
  UNION ALL
  SELECT *, length(head) + length(said) + length(' took ' || qty || ', ') FROM note
)"""

# what of `said` is a listed person: offset, text, and the person's signature
_NOTE_PEOPLE = f"""
{_LIST_LINES}, {_NOTES},
sign AS (
  SELECT person_id, keep, names[1] AS plain_name,
    CASE WHEN starts_with(surname, 'de ') THEN 'de' ELSE '' END AS particle,
    names[1] AS f, coalesce(names[2], '') AS k, CASE WHEN starts_with(surname, 'de ')
      THEN substr(surname, 4) ELSE surname END AS l
  FROM people WHERE len(names) <= 2
),
seen AS (
  SELECT p.*, f AS f_said, CASE kind WHEN 3 THEN k ELSE '' END AS k_said,
    CASE kind WHEN 6 THEN 'de' ELSE '' END AS particle_said,
    CASE kind WHEN 5 THEN 11 ELSE 0 END AS skip
  FROM place p WHERE kind <> 4
  UNION ALL  -- the kind in front of the last word may itself be a first name
  SELECT p.*, k, '', '', length(f) + 1 FROM place p WHERE kind = 3
),
named AS (
  SELECT s.note_id, s.kind, s.l, CAST(spot + skip AS INTEGER) AS start,
    CAST(spot + length(said) AS INTEGER) AS stop, skip,
    substr(said, skip + 1) AS matched, g.person_id, g.plain_name, g.keep, s.text
  FROM seen s JOIN sign g
    ON g.f = s.f_said AND g.l = s.l AND g.k = s.k_said AND g.particle = s.particle_said
),
found AS (
  SELECT a.note_id, start, stop, skip, matched, person_id AS entry_id, plain_name, text,
    CASE WHEN (kind = 6 AND l = 'Anvil') OR EXISTS (
      SELECT 1 FROM named b WHERE b.keep AND b.note_id = a.note_id AND b.start = a.start
    ) THEN 'protected' ELSE 'replaced' END AS status
  FROM named a WHERE NOT keep
)"""

# everybody is a homonym and found with all names only, which end or begin with the last word
_STATUSES = f"""
{_NOTES},
status_line AS (
  SELECT row_number() OVER (ORDER BY line) AS person, line FROM (
    SELECT {_FIRST} || ':' || {_KIND} || ';' || {_LAST} AS line FROM part
    UNION SELECT {_KIND} || ';' || {_LAST} FROM part
  )
),
-- of two people of the same names the first is looked for
searched AS (
  SELECT min(person) AS person, arg_min(line, person) AS line FROM status_line
  GROUP BY list_sort(string_split(split_part(line, ';', 1), ':')), split_part(line, ';', 2)
),
seen AS (
  SELECT note_id, spot, head, said, f || ':' || k || ';' || l AS line, 0 AS skip
  FROM place WHERE kind = 3
  UNION SELECT note_id, spot, head, said, k || ':' || f || ';' || l, 0 FROM place WHERE kind = 3
  UNION SELECT note_id, spot, head, said, k || ';' || l, length(f) + 1 FROM place WHERE kind = 3
  UNION SELECT note_id, spot, head, said, f || ';' || l, CASE kind WHEN 5 THEN 11 ELSE 0 END
  FROM place WHERE kind IN (0, 1, 2, 5)
),
told AS (
  SELECT note_id, spot, said, skip, person, spot > length(head) AS second,
    contains(said, 'Economy Anvil') AS kept,
    min(person) OVER (PARTITION BY note_id, spot) AS winner
  FROM seen JOIN searched USING (line)
),
status AS (
  SELECT note_id, CAST(spot + skip AS INTEGER) AS start,
    CAST(spot + length(said) AS INTEGER) AS "end", substr(said, skip + 1) AS matched,
    person AS entry_id, CASE WHEN kept THEN 'protected' WHEN person > winner THEN 'shadowed'
      WHEN second THEN 'orphan' ELSE 'replaced' END AS status,
    CASE WHEN NOT kept AND person > winner THEN winner ELSE 0 END AS beaten_by
  FROM told
)"""

_KEY = (
    "upper(regexp_replace(array_to_string(list_sort(string_split_regex(matched, '\\s+')), ' '),"
    f" '[^{_L} ]', '', 'g'))"
)

_POWERS = ", ".join(f"'{36**i}'::UHUGEINT" for i in range(24, -1, -1))


def _hash(text: str) -> str:
    number = f"('0x' || md5({text}))::UHUGEINT"
    digits = (
        f"list_transform([{_POWERS}], lambda p: "
        f"substr('0123456789abcdefghijklmnopqrstuvwxyz', (({number} // p) % 36)::INTEGER + 1, 1))"
    )
    return f"substr(ltrim(array_to_string({digits}, ''), '0'), 1, 12)"


_NOTE_EDITS = f"""
{_NOTE_PEOPLE},
keyed AS (SELECT *, {_KEY} AS name_key FROM found WHERE status = 'replaced'),
pseudo AS (
  SELECT name_key, {_hash(f"'{SALT}' || name_key")} AS pseudonym
  FROM (SELECT DISTINCT name_key FROM keyed)
)"""

# `said` twice in a note, so the text is rebuilt around the one pseudonym
_REDACTED_NOTE = """
SELECT note_id, CASE WHEN id IS NULL THEN text
  ELSE head || substr(said, 1, skip) || id || ' took ' || qty || ', '
    || substr(said, 1, skip) || id || '.' END AS text
FROM note LEFT JOIN one USING (note_id)"""

_DICTIONARY = f"""
{_NOTES},
listed AS (
  SELECT row_number() OVER (ORDER BY source, name) AS dict_id, name FROM (
    SELECT DISTINCT 0 AS source, {_FIRST} AS name FROM part
    UNION SELECT DISTINCT 1, {_KIND} FROM part
  )
),
dict AS (SELECT name, min(dict_id) AS dict_id FROM listed GROUP BY name),
found AS (
  SELECT note_id, CAST(spot AS INTEGER) AS start, CAST(spot + length(said) AS INTEGER) AS stop,
    said AS matched,
    CASE WHEN kind = 3 THEN least(a.dict_id, b.dict_id) ELSE a.dict_id END AS entry_id
  FROM place JOIN dict a ON a.name = f JOIN dict b ON b.name = k
  WHERE kind <> 4
),
keyed AS (SELECT *, {_KEY} AS name_key FROM found),
owner AS (
  SELECT name_key, min(entry_id) AS dict_id, min((note_id, start)) AS first
  FROM keyed GROUP BY name_key
),
lettered AS (
  SELECT name_key, dict_id, 'ID' || substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz',
    least(row_number() OVER (PARTITION BY dict_id ORDER BY first, name_key), 52)::INTEGER, 1
  ) || dict_id AS pseudonym
  FROM owner
)"""

# letters of the notes of greater names first; the others' new nominatives go on after them
_BATCHES = f"""
{_DICTIONARY},
part_of AS (
  SELECT name_key, entry_id, note_id, start, CASE WHEN note_id >= '4' THEN 0 ELSE 1 END AS batch
  FROM keyed
),
first_seen AS (
  SELECT name_key, arg_min(entry_id, (batch, note_id, start, entry_id)) AS dict_id,
    min((batch, note_id, start)) AS first
  FROM part_of GROUP BY name_key
),
batched AS (
  SELECT name_key, dict_id, 'ID' || substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz',
    least(row_number() OVER (PARTITION BY dict_id ORDER BY first, name_key), 52)::INTEGER, 1
  ) || dict_id AS pseudonym
  FROM first_seen
)"""

# all names are listed, so any nominative is found whole, by its name of least number
_WORD_DICTIONARY = f"""
{_NOTES},
word AS (
  SELECT unnest(string_split(p_name, ' ')) AS w, 0 AS source FROM part
  UNION ALL SELECT unnest(string_split_regex(text, '[ \t\n\r]+')), 1 FROM documents
),
dict AS (
  SELECT row_number() OVER (ORDER BY source, name) AS dict_id, name FROM (
    SELECT {_cap('w')} AS name, min(source) AS source FROM word
    WHERE regexp_full_match(w, '[A-Za-z]{{2,}}') GROUP BY 1
  )
),
named AS (
  SELECT note_id, spot, said, min(dict_id) AS entry_id FROM (
    SELECT note_id, spot, said, unnest(string_split_regex(said, ' +')) AS w FROM place
    WHERE kind <> 4
  ) JOIN dict ON name = {_cap('w')} AND substr(w, 1, 1) = substr(name, 1, 1)
  GROUP BY note_id, spot, said
)"""

# --- conversations ----------------------------------------------------------------------

_TURN_NODES = """
said AS (
  SELECT conv_id, turn, role, CAST(2 * (i - 1) + CASE WHEN role = 'user' THEN 1 ELSE 0 END + s
    AS INTEGER) AS pos, CASE s WHEN 0 THEN parts[i] ELSE chr(9) END AS text
  FROM (
    SELECT conv_id, turn, role, parts, unnest(range(1, len(parts) + 1)) AS i
    FROM (SELECT conv_id, turn, role, string_split(text, chr(10)) AS parts FROM conversations)
  ), (VALUES (0), (1)) v(s)
)"""

# a block starts with a user turn or another role than the turn before
_SEGMENTS = """
opened AS (
  SELECT conv_id, turn, CASE
    WHEN role = 'user' OR role IS DISTINCT FROM lag(role) OVER w THEN 1 ELSE 0 END AS opens
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
),
numbered AS (
  SELECT conv_id, turn, CAST(sum(opens) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER)
    AS block_idx FROM opened
),
segment AS (
  SELECT *, CAST("to" - length(text) AS BIGINT) AS "from" FROM (
    SELECT n.*, block_idx, CAST(sum(length(text)) OVER (
      PARTITION BY n.conv_id, block_idx ORDER BY turn, pos) AS BIGINT) AS "to"
    FROM nodes n JOIN numbered USING (conv_id, turn)
  )
)"""

_SIGNED = f"""
{_LIST_LINES}, {_TURN_NODES},
signature AS (
  SELECT conv_id, turn, role, f, l, coalesce(f || ' ' || l, 'Nobody Known') AS name,
    turn % 7 + 2 AS cut
  FROM conversations c LEFT JOIN (SELECT p_partkey, {_FIRST} AS f, {_LAST} AS l FROM part)
    ON p_partkey = conv_id * 10 + turn
),
replaced AS (
  SELECT s.conv_id, s.turn, 'ID' || p.person_id AS id FROM signature s JOIN people p
    ON p.names = [s.f] AND p.surname = s.l AND NOT p.keep
  WHERE NOT EXISTS (
    SELECT 1 FROM people q WHERE q.keep AND q.names = [s.f] AND q.surname = s.l)
),
nodes AS (
  SELECT conv_id, turn, role, CAST(pos AS BIGINT) AS pos, text, text AS new_text FROM said
  UNION ALL
  SELECT conv_id, turn, role, (1 << 30)::BIGINT, 'By ' || substr(name, 1, cut),
    CASE WHEN id IS NULL THEN 'By ' || substr(name, 1, cut) ELSE 'By ' || id END
  FROM signature LEFT JOIN replaced USING (conv_id, turn)
  UNION ALL
  SELECT conv_id, turn, role, (1 << 30)::BIGINT + 2, substr(name, cut + 1),
    CASE WHEN id IS NULL THEN substr(name, cut + 1) ELSE '' END
  FROM signature LEFT JOIN replaced USING (conv_id, turn)
  UNION ALL
  SELECT conv_id, turn, role, (1 << 30)::BIGINT + 3, '.', '.' FROM signature
),
{_SEGMENTS},
moved AS (
  SELECT *, CAST(new_to - length(new_text) AS BIGINT) AS new_from FROM (
    SELECT *, CAST(sum(length(new_text)) OVER (
      PARTITION BY conv_id, block_idx ORDER BY turn, pos) AS BIGINT) AS new_to
    FROM segment
  )
)"""

# --- packages ---------------------------------------------------------------------------

_PACKAGES = f"""
{_SIGNED},
package AS (
  SELECT c.conv_id || '-' || c.turn AS doc_id, c.role, name, id,
    string_split(c.text, chr(10)) AS parts
  FROM conversations c JOIN signature s USING (conv_id, turn)
    LEFT JOIN replaced USING (conv_id, turn)
)"""


_TABS = "chr(9) || chr(9)"
_ROW = f"chr(9) || role || {_TABS} || chr(9) || "
_PARAGRAPHS = """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS block_idx, 0::BIGINT AS base, parts[i] AS text
FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM package)"""


def _package_blocks(name: str) -> str:
    return f"""{_PARAGRAPHS}
UNION ALL SELECT doc_id, CAST(len(parts) AS INTEGER), 0, {_ROW} {name} || {_TABS} FROM package
UNION ALL SELECT doc_id, CAST(len(parts) + 1 AS INTEGER), 0, 'Signed ' || {name} FROM package"""


# an ID ends in a digit, so a piece ends after it
_REDACTED_PACKAGES = f"""{_PARAGRAPHS}
UNION ALL SELECT doc_id, CAST(len(parts) AS INTEGER), 0,
  CASE WHEN id IS NULL THEN {_ROW} name || {_TABS} ELSE {_ROW} id END FROM package
UNION ALL SELECT doc_id, CAST(len(parts) AS INTEGER), length({_ROW} id), {_TABS}
  FROM package WHERE id IS NOT NULL
UNION ALL SELECT doc_id, CAST(len(parts) + 1 AS INTEGER), 0, 'Signed ' || coalesce(id, name)
  FROM package"""


def _story(after: int, part: str, head: str) -> str:
    return f"""
UNION ALL SELECT doc_id, CAST(len(parts) + {after} AS INTEGER), 0, '{part}', {head}"""


# header, footers, endnotes, footnotes, comments: by kind, then by name
_STORIES = (
    f"SELECT doc_id, block_idx, base, 'word/main.xml' AS part, text FROM ({_PARAGRAPHS})"
    + _story(0, "word/heads.xml", "role FROM package")
    + _story(1, "foot/f.xml", "'Page of ' || coalesce(id, name) FROM package")
    + _story(2, "word/footer2.xml", "'Signed ' || coalesce(id, name) FROM package")
    + _story(3, "word/ends.xml", "'Ends ' || coalesce(id, name || '.') FROM package")
    + """
UNION ALL SELECT doc_id, CAST(len(parts) + 3 AS INTEGER), length('Ends ' || id), 'word/ends.xml', '.'
FROM package WHERE id IS NOT NULL"""
    + _story(4, "word/notes/below.xml", "'Note by ' || coalesce(id, name) FROM package")
    + _story(5, "word/said.xml", "'Said of ' || coalesce(id, name) FROM package")
)


# --- pages ------------------------------------------------------------------------------

_PAGE_TOKEN = (
    "(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>|</?[a-z!][^<>]*>|[^<]+|<"
)
_PAGE_NODES = f"""
token AS (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, tokens[i] AS token
  FROM (
    SELECT page_id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM (
      SELECT page_id, regexp_extract_all(html, '{_PAGE_TOKEN}') AS tokens FROM pages)
  )
),
sorted AS (
  SELECT page_id, pos, token, CASE
    WHEN regexp_matches(token, '(?is)^(<!--|<script\\b|<style\\b)') THEN 'skipped'
    WHEN NOT (starts_with(token, '<') AND ends_with(token, '>')) THEN 'text'
    ELSE 'tag' END AS sort,
    lower(regexp_extract(token, '^</?([A-Za-z][A-Za-z0-9]*)[^<>]*>$', 1)) AS name
  FROM token
),
page_node AS (
  SELECT page_id, pos, CASE sort WHEN 'tag' THEN name ELSE '' END AS tag,
    CASE WHEN sort = 'skipped' THEN 'ignore' WHEN sort = 'text' THEN 'text'
      WHEN name = 'br' THEN 'separator'
      WHEN name IN ('a', 'b', 'i', 'em', 'strong', 'span') THEN 'ignore'
      ELSE 'break' END AS action,
    CASE sort WHEN 'text' THEN token END AS text
  FROM sorted
)"""


_MANY_NAMES = """
ws AS (
  SELECT list(w ORDER BY w) AS ws FROM (
    SELECT DISTINCT upper(substr(v, 1, 1)) || lower(substr(v, 2)) AS w
    FROM (SELECT unnest(string_split(p_name, ' ')) AS v FROM part))
),
person AS (
  SELECT c, own, list_transform(ws[1:c], lambda w: w || own) AS names,
    upper(substr(r, 1, 1)) || lower(substr(r, 2)) || own AS surname
  FROM (
    SELECT c, ws, reverse(ws[1]) AS r, substr('abcdefghijklmno', c + 1, 1) AS own
    FROM ws, (SELECT unnest([4, 5, 6, 7, 8, 9, 10]) AS c))
),
said AS (
  SELECT o_orderkey, p.c, surname, o_orderkey % 2 = 0 AS last_first,
    names[1 + o_orderkey % p.c] AS a, names[1 + (o_orderkey // 7) % p.c] AS b,
    names[1 + (o_orderkey // 49) % p.c] AS z
  FROM orders JOIN person p ON p.c = 4 + o_orderkey % 7
),
-- as many names next to the surname as differ
run AS (
  SELECT *, CASE WHEN last_first THEN
      CASE WHEN a = b THEN [a] WHEN z = a OR z = b THEN [a, b] ELSE [a, b, z] END
    ELSE CASE WHEN z = b THEN [z] WHEN a = b OR a = z THEN [b, z] ELSE [a, b, z] END
    END AS names
  FROM said
),
spelt AS (
  SELECT *, CASE WHEN last_first THEN surname || ' ' || array_to_string(names, ' ')
      ELSE array_to_string(names, ' ') || ' ' || surname END AS matched,
    'paid by ' || CASE WHEN last_first THEN surname || ' ' || a || ' ' || b || ' ' || z
      ELSE a || ' ' || b || ' ' || z || ' ' || surname END AS text
  FROM run
)"""
_MANY_NAMES_AUDIT = """SELECT o_orderkey, CAST(start AS INTEGER) AS start,
  CAST(start + length(matched) AS INTEGER) AS "end", matched,
  CAST(c - 3 AS BIGINT) AS entry_id, 'replaced' AS status
FROM (SELECT *, CASE WHEN last_first THEN 8 ELSE length(text) - length(matched) END AS start
  FROM spelt)"""
# a person is told by all names only, in any order
_MANY_HOMONYMS = """
twin AS (
  SELECT o_orderkey, o_orderkey % 3 AS kind, p.c, (o_orderkey // 3) % 2 AS second,
    names[1 + (o_orderkey // 6) % p.c :] || names[: (o_orderkey // 6) % p.c] AS turned,
    surname || CASE WHEN (o_orderkey // 3) % 2 = 1 THEN 'i' ELSE '' END AS last
  FROM orders JOIN person p ON p.c = 4 + o_orderkey % 7
),
whole AS (
  SELECT *, CASE kind WHEN 0 THEN array_to_string(turned, ' ') || ' ' || last
    ELSE last || ' ' || array_to_string(turned, ' ') END AS matched
  FROM twin WHERE kind < 2
)"""
_MANY_HOMONYMS_AUDIT = """SELECT o_orderkey, CAST(8 AS INTEGER) AS start,
  CAST(8 + length(matched) AS INTEGER) AS "end", matched,
  CAST(2 * (c - 4) + second + 1 AS BIGINT) AS entry_id, 'replaced' AS status FROM whole"""
NESTED_KEEP = ("The", "The of", "of the", "the", "e", "General Public License", "Public")
_NESTED = f"""
SELECT doc_id, block_idx, CAST(p AS INTEGER) AS start,
  CAST(max(p + length(expr)) AS INTEGER) AS "end"
FROM (
  SELECT doc_id, block_idx, text, expr, unnest(range(0, length(text))) AS p
  FROM lines, (VALUES {", ".join(f"('{e}')" for e in NESTED_KEEP)}) AS k(expr)
  WHERE contains(text, expr)
) WHERE substr(text, p + 1, length(expr)) = expr GROUP BY doc_id, block_idx, p"""


# each window of a line that has the length of a word, looked up among the words
_WORD_KEEP = f"""
WITH {_LINES.strip()},
word AS (
  SELECT DISTINCT w FROM (
    SELECT unnest(string_split_regex(text, '[ \t\n\r]+')) AS w FROM documents)
  WHERE length(w) >= 4
),
line AS (SELECT text, length(text) AS n FROM lines GROUP BY text),
place AS (SELECT text, n, unnest(range(0, n)) AS p FROM line),
hit AS (
  SELECT text, p, max(size) AS size FROM (
    SELECT text, p, size, substr(text, p + 1, size) AS piece
    FROM place, (SELECT DISTINCT length(w) AS size FROM word) WHERE p + size <= n
  ) SEMI JOIN word ON piece = w GROUP BY text, p
)
SELECT doc_id, block_idx, count(*) AS n, CAST(min(p) AS INTEGER) AS first,
  CAST(max(p) AS INTEGER) AS last, CAST(sum((p + size) * (p % 97 + 1)) AS BIGINT) AS checksum
FROM lines JOIN hit USING (text) GROUP BY doc_id, block_idx"""


_APOSTROPHES = """
WITH person AS (
  SELECT row_number() OVER (ORDER BY name) AS entry_id, *
  FROM (
    SELECT DISTINCT p_type, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS name,
      upper(substr(reverse(p_type), 1, 1)) || lower(substr(reverse(p_type), 2)) AS tail
    FROM part)
)
SELECT p_partkey, CAST(3 AS INTEGER) AS start, CAST(3 + length(matched) AS INTEGER) AS "end",
  matched, entry_id, 'replaced' AS status
FROM (
  SELECT p_partkey, entry_id, CASE p_partkey % 4
    WHEN 0 THEN name || ' D' || chr(39) || tail
    WHEN 1 THEN 'D’' || tail || ' ' || name
    WHEN 2 THEN name || ' D` ' || tail
    ELSE 'D´' || upper(tail) || chr(9) || name END AS matched
  FROM part JOIN person USING (p_type))"""


def _report(header: str, key: str, value: str, rows: str) -> str:
    line = f"'Key: ' || {key} || chr(9) || 'Value: ' || {value}"
    return f"SELECT '{header}:' AS value UNION ALL SELECT {line} FROM ({rows})"


def _with(ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes.strip()}\n{body}"


def oracle_sql() -> dict[str, str]:
    note_audit = _with(
        _NOTE_PEOPLE,
        'SELECT note_id, start, stop AS "end", matched, entry_id, status FROM found',
    )
    dictionary_spans = _with(
        _DICTIONARY, 'SELECT note_id, start, stop AS "end", matched, entry_id FROM found'
    )
    keep_lines = ", ".join(f"('{e}')" for e in DEFAULT_KEEP_EXPRESSIONS)
    return {
        "line_blocks": _with(
            _LINES,
            "SELECT doc_id, block_idx, text, CAST(length(text) AS INTEGER) AS n_chars FROM lines",
        ),
        "gate_stats": _with(
            _LINES,
            "SELECT lang, source, count(*) AS blocks, "
            f"CAST(count(*) FILTER (regexp_matches(text, '{_GATE}')) AS BIGINT) AS gated "
            "FROM lines GROUP BY lang, source",
        ),
        "list_spans": _with(
            _DOCUMENT_SPANS,
            'SELECT doc_id, block_idx, start, stop AS "end", '
            "substr(text, start + 1, stop - start) AS matched, "
            "CAST(entry_id AS BIGINT) AS entry_id, status FROM judged",
        ),
        "list_redact": _with(
            _DOCUMENT_SPANS,
            """, pieces AS (
  SELECT doc_id, block_idx, start, stop, text, entry_id,
    lag(stop, 1, 0) OVER (PARTITION BY doc_id, block_idx ORDER BY start) AS before
  FROM judged WHERE status = 'replaced'
), rebuilt AS (
  SELECT doc_id, block_idx, string_agg(
    substr(text, before + 1, start - before) || 'ID' || entry_id, '' ORDER BY start)
    || substr(any_value(text), max(stop) + 1) AS text
  FROM pieces GROUP BY doc_id, block_idx
)
SELECT l.doc_id, l.block_idx, coalesce(r.text, l.text) AS text
FROM lines l LEFT JOIN rebuilt r USING (doc_id, block_idx)""",
        ),
        "document_frequencies": _with(
            _DOCUMENT_SPANS,
            "SELECT plain_name, count(*) AS cnt FROM judged "
            "WHERE status = 'replaced' GROUP BY plain_name ORDER BY cnt DESC, plain_name",
        ),
        "validate_people": _with(
            _LIST_LINES, "SELECT line_no, line, is_valid FROM checked"
        ),
        "validate_name_counts": f"""
SELECT p_partkey AS line_no, repeat({_FIRST} || ':', p_partkey % 12) || {_FIRST} || ';' || {_LAST}
  AS line, p_partkey % 12 < 10 AS is_valid
FROM part""",
        "people_list": _with(
            _LIST_LINES,
            "SELECT person_id, array_to_string(names, ':') AS names, surname, keep, "
            "CASE WHEN NOT keep THEN 'ID' || person_id END AS pseudonym, "
            "names[1] AS plain_name FROM people",
        ),
        "people_homonyms": _with(
            _LIST_LINES,
            "SELECT person_id, array_to_string(names, ':') AS names, surname, keep, "
            "has_homonym FROM marked",
        ),
        "people_variants": _with(
            _LIST_LINES + "," + _CHOICES,
            "SELECT person_id, rank AS variant_rank, array_to_string("
            "list_transform(path, lambda i: names[i]), ' ') AS terms FROM ranked",
            recursive=True,
        ),
        "people_variants_homonym": _with(
            _LIST_LINES + "," + _CHOICES,
            "SELECT person_id, rank AS variant_rank, array_to_string("
            "list_transform(path, lambda i: names[i]), ' ') AS terms FROM ranked "
            "WHERE NOT has_homonym OR len(path) = n",
            recursive=True,
        ),
        "person_forms": _with(
            _LIST_LINES + "," + _CHOICES,
            """, spelt AS (
  SELECT person_id, rank, surname, NOT has_homonym OR len(path) = n AS fits,
    list_transform(path, lambda i: names[i]) AS terms FROM ranked
)
SELECT person_id, rank AS variant_rank, form, CASE form
    WHEN 'names first' THEN t || ' ' || surname
    WHEN 'surname first' THEN surname || chr(9) || ' ' || chr(10)
      || array_to_string(terms, chr(10))
    WHEN 'upper surname' THEN t || ' ' || upper(surname)
    WHEN 'lower' THEN lower(t || ' ' || surname)
    WHEN 'glued' THEN t || ' ' || surname || 'è'
    ELSE 'l''' || t || ' ' || surname || '''' END AS text,
  fits AND form NOT IN ('lower', 'glued') AS accepted
FROM (SELECT *, array_to_string(terms, ' ') AS t FROM spelt),
  (VALUES ('names first'), ('surname first'), ('upper surname'), ('lower'), ('glued'),
    ('quoted')) v(form)""",
            recursive=True,
        ),
        "keep_expressions": f"""
WITH e AS (SELECT * FROM (VALUES {keep_lines}) v(expr)
  UNION SELECT 'Il ' || {_cap('n_name')} FROM nation)
SELECT expr FROM e UNION SELECT upper(expr) FROM e""",
        "name_dictionary": _with(_DICTIONARY, "SELECT dict_id, name FROM listed"),
        "protected_spans": _with(
            _NOTE_PEOPLE,
            """SELECT note_id, start, stop AS "end" FROM named WHERE keep
UNION SELECT note_id, CAST(spot AS INTEGER), CAST(spot + 10 AS INTEGER) FROM place WHERE kind = 5
UNION SELECT note_id, CAST(spot + length(f) + 1 AS INTEGER), CAST(spot + length(said) AS INTEGER)
FROM place WHERE kind = 6 AND l = 'Anvil'""",
        ),
        "spans_after_keep": _with(
            _NOTE_PEOPLE,
            'SELECT note_id, start, stop AS "end", matched FROM found WHERE status = \'replaced\'',
        ),
        # a kept kind in the middle of a match protects it by one rule only
        "spans_after_keep_edge": _with(
            _NOTE_PEOPLE,
            """SELECT note_id, start, stop AS "end", matched FROM found
WHERE status = 'replaced' AND NOT starts_with(matched, 'Economy')
  AND NOT ends_with(matched, 'Economy')""",
        ),
        "match_audit": note_audit,
        "match_audit_joined": note_audit,
        "match_statuses": _with(_STATUSES, "SELECT * FROM status"),
        "match_statuses_joined": _with(_STATUSES, "SELECT * FROM status"),
        "match_status_counts": _with(
            _STATUSES,
            "SELECT status, count(*) AS n, count(DISTINCT entry_id) AS people FROM status "
            "GROUP BY status",
        ),
        "notes_redacted": _with(
            _NOTE_EDITS
            + """, one AS (
  SELECT DISTINCT note_id, skip, pseudonym AS id FROM keyed JOIN pseudo USING (name_key))""",
            _REDACTED_NOTE,
        ),
        "notes_streamed": _with(
            _NOTE_EDITS
            + """, one AS (
  SELECT DISTINCT note_id, skip, pseudonym AS id FROM keyed JOIN pseudo USING (name_key))""",
            _REDACTED_NOTE,
        ),
        "name_frequencies": _with(
            _NOTE_PEOPLE,
            "SELECT plain_name, count(*) AS cnt FROM found WHERE status = 'replaced' "
            "GROUP BY plain_name ORDER BY cnt DESC, plain_name",
        ),
        "associations": _with(
            _NOTE_EDITS, "SELECT name_key, pseudonym FROM pseudo ORDER BY name_key"
        ),
        "apostrophes": _APOSTROPHES,
        "homonyms_many_names": _with(_MANY_NAMES + "," + _MANY_HOMONYMS, _MANY_HOMONYMS_AUDIT),
        "many_names": _with(_MANY_NAMES, _MANY_NAMES_AUDIT),
        "many_names_inline": _with(_MANY_NAMES, _MANY_NAMES_AUDIT),
        "many_names_joined": _with(_MANY_NAMES, _MANY_NAMES_AUDIT),
        "nested_keep_expressions": _with(_LINES, _NESTED),
        "nested_keep_expressions_held": _with(_LINES, _NESTED),
        "nested_keep_expressions_joined": _with(_LINES, _NESTED),
        "word_keep_expressions": _WORD_KEEP,
        "word_keep_expressions_joined": _WORD_KEEP,
        "frequency_report": _report(
            "FREQUENCIES",
            "plain_name",
            "cnt",
            _with(
                _NOTE_PEOPLE,
                "SELECT plain_name, count(*) AS cnt FROM found WHERE status = 'replaced' "
                "GROUP BY plain_name",
            ),
        ),
        "association_report": _report(
            "ASSOCIATIONS",
            "name_key",
            "pseudonym",
            _with(_NOTE_EDITS, "SELECT name_key, pseudonym FROM pseudo"),
        ),
        "protected_shift": _with(
            _NOTE_EDITS
            + """, kept AS (
  SELECT note_id, spot, spot AS b, spot + 10 AS e FROM place WHERE kind = 5
  UNION ALL SELECT note_id, spot, spot + length(f) + 1, spot + length(said)
  FROM place WHERE kind = 6 AND l = 'Anvil'
), change AS (
  SELECT note_id, start, length(pseudonym) - length(matched) AS delta
  FROM keyed JOIN pseudo USING (name_key)
)""",
            """SELECT note_id, CAST(b AS INTEGER) AS start, CAST(e AS INTEGER) AS "end",
  CAST(b + move AS INTEGER) AS shifted_start, CAST(e + move AS INTEGER) AS shifted_end
FROM (
  SELECT k.note_id, b, e, coalesce(sum(delta), 0) AS move
  FROM kept k LEFT JOIN change c ON c.note_id = k.note_id AND c.start < k.b
  GROUP BY k.note_id, b, e
)""",
        ),
        "dictionary_spans": dictionary_spans,
        "dictionary_spans_joined": dictionary_spans,
        "word_dictionary_spans": _with(
            _WORD_DICTIONARY,
            'SELECT note_id, CAST(spot AS INTEGER) AS start, CAST(spot + length(said) AS INTEGER) '
            'AS "end", said AS matched, entry_id FROM named',
        ),
        "word_dictionary_size": _with(
            _WORD_DICTIONARY,
            "SELECT substr(name, 1, 1) AS letter, count(*) AS names, "
            "CAST(sum(dict_id) AS BIGINT) AS numbers FROM dict GROUP BY 1",
        ),
        "lettered_ids": _with(
            _DICTIONARY, "SELECT name_key, dict_id, pseudonym FROM lettered"
        ),
        "lettered_batches": _with(_BATCHES, "SELECT name_key, dict_id, pseudonym FROM batched"),
        "batches_redacted": _with(
            _BATCHES
            + """, one AS (
  SELECT DISTINCT note_id, 0 AS skip, pseudonym AS id
  FROM keyed JOIN batched USING (name_key))""",
            _REDACTED_NOTE,
        ),
        "dictionary_redacted": _with(
            _DICTIONARY
            + """, one AS (
  SELECT DISTINCT note_id, 0 AS skip, pseudonym AS id
  FROM keyed JOIN lettered USING (name_key))""",
            _REDACTED_NOTE,
        ),
        "name_keys": _with(_DICTIONARY, "SELECT DISTINCT matched, name_key FROM keyed"),
        "hash_ids": f"""
WITH k AS (SELECT p_partkey, {_KEY} AS name_key
  FROM (SELECT p_partkey, {_FIRST} || ' ' || {_LAST} AS matched FROM part))
SELECT p_partkey, name_key, {_hash(f"'{SALT}' || name_key || ' ' || p_partkey")} AS hash FROM k""",
        "turn_segments": _with(
            _TURN_NODES + ", nodes AS (SELECT * FROM said)," + _SEGMENTS,
            'SELECT conv_id, turn, pos, block_idx, "from", "to", text FROM segment',
        ),
        "segment_stats": _with(
            _TURN_NODES + ", nodes AS (SELECT * FROM said)," + _SEGMENTS,
            'SELECT conv_id, block_idx, count(*) AS n_segments, min("from") AS first_from, '
            'max("to") AS last_to FROM segment GROUP BY conv_id, block_idx',
        ),
        "turn_blocks": _with(
            _SIGNED,
            f"""SELECT conv_id, block_idx, min("from") AS base,
  string_agg(text, '' ORDER BY turn, pos) AS text
FROM (
  SELECT *, coalesce(sum(cut) OVER (PARTITION BY conv_id, block_idx ORDER BY turn, pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece
  FROM (
    SELECT *, CASE WHEN text <> '' AND NOT regexp_matches(text, '[{_L}{_APOS}\\s]$')
      THEN 1 ELSE 0 END AS cut FROM segment
  )
) GROUP BY conv_id, block_idx, piece""",
        ),
        "segment_remap": _with(
            _SIGNED,
            'SELECT conv_id, block_idx, "from", "to", new_from, new_to FROM moved',
        ),
        "segment_text": _with(
            _SIGNED, "SELECT conv_id, block_idx, new_from, new_to, new_text AS text FROM moved"
        ),
        "segment_text_joined": _with(
            _SIGNED, "SELECT conv_id, block_idx, new_from, new_to, new_text AS text FROM moved"
        ),
        "package_stories": _with(_PACKAGES, _STORIES),
        "package_tags": _with(
            _PACKAGES,
            """SELECT doc_id, part, tag, CAST(n AS BIGINT) AS n FROM (
  SELECT doc_id, 'word/document.xml' AS part,
    unnest(['p', 'r', 't', 'rPr', 'b', 'tc', 'tcPr', 'tr', 'tbl', 'body', 'part', 'proofErr'])
      AS tag,
    unnest([len(parts) + 2, len(parts) + 3, len(parts) + 3, len(parts) + 3, len(parts) + 3,
      2, 2, 1, 1, 1, 1, 1]) AS n FROM package
  UNION ALL
  SELECT doc_id, 'word/header1.xml',
    unnest(['p', 'r', 't', 'rPr', 'b', 'sdt', 'sdtContent', 'part']),
    unnest([1, 2, 2, 2, 2, 1, 1, 1]) FROM package
)""",
        ),
        "package_blocks": _with(_PACKAGES, _package_blocks("name")),
        "package_redacted": _with(_PACKAGES, _REDACTED_PACKAGES),
        "package_files": _with(
            _PACKAGES,
            f"""SELECT role || '/' || doc_id || '-result.docx' AS result,
  CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM ({_REDACTED_PACKAGES}) JOIN package USING (doc_id) GROUP BY role, doc_id""",
        ),
        "page_nodes": _with(_PAGE_NODES, "SELECT page_id, pos, tag, action, text FROM page_node"),
        "page_blocks": _with(
            _PAGE_NODES
            + """, counted AS (
  SELECT *, sum(CASE action WHEN 'break' THEN 1 ELSE 0 END)
    OVER (PARTITION BY page_id ORDER BY pos) AS breaks
  FROM page_node WHERE action <> 'ignore'
)""",
            """SELECT page_id, CAST(dense_rank() OVER (PARTITION BY page_id ORDER BY breaks) - 1
  AS INTEGER) AS block_idx, text, CAST(n AS INTEGER) AS n_segments
FROM (
  SELECT page_id, breaks, count(*) AS n, string_agg(
    CASE action WHEN 'separator' THEN chr(9) ELSE text END, '' ORDER BY pos) AS text
  FROM counted WHERE action <> 'break' GROUP BY page_id, breaks
)""",
        ),
    }
