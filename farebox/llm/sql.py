"""The corpus queries in DuckDB SQL, where SQL can say them."""

from __future__ import annotations

from farebox.llm import chat, contamination, divergence, licenses, lines, middle, urls, warc

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _word_list(column: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), {_LETTERS}), '{_WORD}')"


def _rule_case(what: int) -> str:
    cases = []
    for r in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2])):
        fits = f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')"
        cases.append(f"WHEN {fits} THEN '{r[0] if what == 0 else r[1] + r[2]}'")
    return "CASE " + " ".join(cases) + " END"


URLS = f"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), {_LETTERS}) AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), judged AS (
  SELECT *, host <> '' AND regexp_matches(host, '{urls.LISTED_NAME}') AS listed FROM parts
)
SELECT page_id, host, path, {_rule_case(1)} AS rule,
  coalesce({_rule_case(0)}, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM judged
"""


def _values(rows: list[tuple[str, str, bool]]) -> str:
    return ", ".join(f"('{a}', '{b}', {str(c).lower()})" for a, b, c in rows)


LICENSES = f"""
WITH names(label, phrase, base) AS (
  VALUES {_values([(v, k, True) for k, v in licenses.PHRASES.items()] + [(k, v, False) for k, v in licenses.TEMPLATES.items()])}
), t AS (
  SELECT label, base, i - 1 AS t_pos, w[i] AS a, w[i + 1] AS b, len(w) - 1 AS pairs
  FROM (SELECT label, base, string_split(phrase, ' ') AS w FROM names), unnest(range(1, len(w))) AS u(i)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_word_list('text')} AS w FROM documents
), pairs_of AS (
  SELECT r, i - 1 AS pos, w[i] AS a, w[i + 1] AS b FROM docs, unnest(range(1, len(w))) AS u(i)
), found AS (
  SELECT r, label, base, pairs, t_pos, pos, pos - t_pos AS diagonal FROM pairs_of JOIN t USING (a, b)
), phrases AS (
  SELECT r, label, diagonal FROM found WHERE base GROUP BY r, label, pairs, diagonal HAVING count(DISTINCT t_pos) = pairs
), bands AS (
  SELECT r, label, pairs, diagonal - j AS low, g, count(DISTINCT t_pos) AS votes, max(pos) - min(pos) + 1 AS span_pairs
  FROM found, range(0, {licenses.GAP} + 1) AS u(g), range(0, {licenses.GAP} + 1) AS v(j)
  WHERE NOT base AND j <= g GROUP BY ALL
), own AS (
  SELECT r, label, votes::DOUBLE / greatest(pairs, span_pairs) AS score FROM bands
  WHERE votes::DOUBLE / greatest(pairs, span_pairs) >= {licenses.SHARE}
), every AS (
  SELECT r, label, true AS base, diagonal AS start_word, 1.0::DOUBLE AS score FROM phrases
  UNION ALL SELECT r, label, false, NULL, score FROM own
)
SELECT d.doc_id, len(any_value(d.w))::BIGINT AS n_words, count(e.start_word)::BIGINT AS n_base,
  min(e.start_word)::BIGINT AS first_word, max(e.start_word)::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT CASE WHEN e.base THEN e.label END, ',' ORDER BY CASE WHEN e.base THEN e.label END), '') AS base_labels,
  coalesce(string_agg(DISTINCT e.label, ',' ORDER BY e.label), '') AS labels,
  coalesce(max(e.score), 0.0)::DOUBLE AS score
FROM docs d LEFT JOIN every e USING (r) GROUP BY d.r, d.doc_id
"""


WARC = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), o AS (
  SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= {warc.LEAST_REVISIT} GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN original IS DISTINCT FROM page_id AND o.payload_digest IS NOT NULL AND payload_bytes >= {warc.LEAST_REVISIT}
    THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original IS DISTINCT FROM page_id AND payload_bytes >= {warc.LEAST_REVISIT} THEN original END AS refers_to
FROM p LEFT JOIN o USING (payload_digest)
"""


CONTAMINATION = f"""
WITH items AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {_word_list('text')} AS w FROM benchmark
), spans AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS phrase
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_word_list('text')} AS w FROM documents
), sizes AS (
  SELECT DISTINCT n FROM spans
), places AS (
  SELECT r, n, i AS start, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)
), found AS (
  SELECT DISTINCT p.r, p.n, p.start, s.item FROM places p JOIN spans s ON p.n = s.n AND p.phrase = s.phrase
), hit AS (
  SELECT r, count(DISTINCT start + j) AS n_hit FROM found, unnest(range(0, n)) AS u(j) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY r
), keyed AS (
  SELECT row_number() OVER () AS ik, item, w FROM items WHERE len(w) > 0
), item_places AS (
  SELECT ik, item, i - 1 AS ipos, w[i] AS term FROM keyed, unnest(range(1, len(w) + 1)) AS u(i)
), postings AS (
  SELECT r, i - 1 AS pos, w[i] AS term FROM docs, unnest(range(1, len(w) + 1)) AS u(i) WHERE w[i] IN (SELECT term FROM item_places)
), counts AS (
  SELECT term, count(*) AS n FROM postings GROUP BY term
), rated AS (
  SELECT ik, item, ipos, term, coalesce(n, 0) AS n FROM item_places LEFT JOIN counts USING (term)
), rare AS (
  SELECT DISTINCT k.ik, k.item, p.ipos, p.term
  FROM keyed k, unnest(range(0, len(k.w) - least({contamination.WINDOW}, len(k.w)) + 1)) AS u(s)
  JOIN rated p ON p.ik = k.ik AND p.ipos >= s AND p.ipos < s + least({contamination.WINDOW}, len(k.w))
  QUALIFY row_number() OVER (PARTITION BY k.ik, s ORDER BY p.n, p.ipos) <= {contamination.RARE}
), wanted AS (
  SELECT ik, count(DISTINCT ipos) AS wanted FROM rare GROUP BY ik
), close AS (
  SELECT p.r, a.ik, a.item, b, floor((p.pos - a.ipos + b * {contamination.SLOP}) / {2 * contamination.SLOP}.0) AS band, count(DISTINCT a.ipos) AS seen
  FROM postings p JOIN rare a USING (term), (VALUES (0), (1)) AS v(b) GROUP BY ALL
), near AS (
  SELECT r, string_agg(DISTINCT item, ',' ORDER BY item) AS near_items FROM close JOIN wanted USING (ik)
  WHERE seen >= {contamination.LEAST} AND seen >= {contamination.SHARE} * wanted GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(near_items, '') AS near_items
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN near USING (r)
"""


_FIELD = f"'{lines.FIELD}'"
_BLANK = "chr(9) || chr(11) || chr(12) || chr(13) || ' '"


def _telling(template: str) -> str:
    """Whether the constants of a template tell a line of ``tokens`` and ``rest`` from ordinary ones."""
    leading = f"len(list_filter(tokens[1:{lines.DEPTH}], lambda x: x <> {_FIELD}))"
    constants = f"len(list_filter({template}, lambda x: x <> {_FIELD}))"
    words = f"len(list_filter(range(1, len(rest) + 1), lambda i: {template}[i] = {_FIELD} AND rest[i] <> {_FIELD}))"
    real = f"({leading} + {constants})"
    return f"({real} > 0 AND 2 * {real} >= len(tokens) AND ({words} = 0 OR {constants} > {words}))"


LINES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {{'d': doc_id, 't': text}} AS doc, string_split(text, chr(10)) AS l FROM documents
), raw AS (
  SELECT r, doc, i - 1 AS pos, regexp_replace(trim(l[i], {_BLANK}), '[ \\t\\x0B\\f\\r]+', ' ', 'g') AS line
  FROM docs, unnest(range(1, len(l) + 1)) AS u(i)
), every_line AS (
  SELECT *, list_transform(string_split(line, ' '), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN {_FIELD} ELSE x END) AS tokens
  FROM raw WHERE line <> ''
), leaf_lines AS (
  SELECT *, {{'n': len(tokens), 'head': tokens[1:{lines.DEPTH}]}} AS leaf, tokens[{lines.DEPTH + 1}:] AS rest FROM every_line
), leaves AS (
  SELECT leaf FROM leaf_lines GROUP BY leaf HAVING count(DISTINCT doc) >= {lines.MIN_DOCS}
), taken AS (
  SELECT * FROM leaf_lines SEMI JOIN leaves USING (leaf)
), sizes AS (
  SELECT leaf, count(*) AS members FROM taken GROUP BY leaf
), counted AS (
  SELECT leaf, i, rest[i] AS token, count(*) AS c FROM taken, unnest(range(1, len(rest) + 1)) AS u(i) GROUP BY ALL
), top AS (
  SELECT leaf, i, max({{'c': c, 'token': token}}) AS t FROM counted GROUP BY ALL
), template AS (
  SELECT leaf, list(CASE WHEN t.c >= {lines.CONSTANT} * members THEN t.token ELSE {_FIELD} END ORDER BY i) AS template
  FROM top JOIN sizes USING (leaf) GROUP BY leaf
), rated AS (
  SELECT t.*, coalesce(template, []) AS template FROM taken t LEFT JOIN template USING (leaf)
), followed AS (
  SELECT *, len(tokens) > 1 AND {_telling('template')}
    AND len(list_filter(range(1, len(rest) + 1), lambda i: rest[i] = template[i] AND template[i] <> {_FIELD}))
      >= {lines.AGREE} * len(list_filter(template, lambda x: x <> {_FIELD})) AS follows
  FROM rated
), forms AS (
  SELECT leaf, tokens, rest, count(*) AS n FROM followed WHERE NOT follows GROUP BY ALL HAVING len(tokens) > {lines.DEPTH}
), frequent AS (
  SELECT leaf, i, rest[i] AS token FROM forms, unnest(range(1, len(rest) + 1)) AS u(i)
  WHERE rest[i] <> {_FIELD} GROUP BY leaf, i, rest[i] HAVING sum(n) >= {lines.MIN_DOCS}
), held AS (
  SELECT f.leaf, f.tokens, f.rest, list(CASE WHEN q.token IS NULL THEN {_FIELD} ELSE q.token END ORDER BY f.i) AS minor, count(q.token) AS hits
  FROM (SELECT *, unnest(range(1, len(rest) + 1)) AS i FROM forms) f LEFT JOIN frequent q ON q.leaf = f.leaf AND q.i = f.i AND q.token = f.rest[f.i]
  GROUP BY f.leaf, f.tokens, f.rest
), minors AS (
  SELECT leaf, tokens, minor FROM held WHERE hits > 0 AND {_telling('minor')}
), members AS (
  SELECT r, doc, pos, line, CASE WHEN follows THEN {{'leaf': f.leaf, 'minor': NULL::VARCHAR[], 'line': NULL::VARCHAR}}
    WHEN minor IS NOT NULL THEN {{'leaf': f.leaf, 'minor': minor, 'line': NULL::VARCHAR}}
    ELSE {{'leaf': f.leaf, 'minor': NULL::VARCHAR[], 'line': line}} END AS unit
  FROM followed f LEFT JOIN minors m ON m.leaf = f.leaf AND m.tokens = f.tokens AND NOT follows
), spread AS (
  SELECT unit, min({{'doc': doc, 'pos': pos}}) AS first FROM members GROUP BY unit HAVING count(DISTINCT doc) >= {lines.MIN_DOCS}
), inside AS (
  SELECT DISTINCT doc, pos FROM members SEMI JOIN spread USING (unit)
), around AS (
  SELECT l.doc, list(line ORDER BY line) FILTER (WHERE i.pos IS NULL) AS around
  FROM every_line l LEFT JOIN inside i ON i.doc = l.doc AND i.pos = l.pos GROUP BY l.doc
  HAVING coalesce(sum(strlen(line)) FILTER (WHERE i.pos IS NULL), 0) >= {lines.OWN_SHARE}::DOUBLE * sum(strlen(line))
), chosen AS (
  SELECT unit, any_value(first) AS first FROM members JOIN spread USING (unit) JOIN around USING (doc)
  GROUP BY unit HAVING count(DISTINCT coalesce(around, [])) >= {lines.MIN_CONTEXTS}
), gone AS (
  SELECT r, list(pos) AS gone FROM members JOIN chosen USING (unit) WHERE first IS DISTINCT FROM {{'doc': doc, 'pos': pos}} GROUP BY r
)
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped,
  sha256(coalesce(array_to_string(
    list_transform(list_filter(range(1, len(l) + 1), lambda i: gone IS NULL OR NOT list_contains(gone, i - 1)), lambda i: l[i]), chr(10)), '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (r)
"""


DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), t AS (
  SELECT r, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), n AS (
  SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, term, coalesce(c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 2)) // (coalesce(n, 0) + 2 * v) AS p
  FROM g JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 2)) // (any_value(n) + 2 * any_value(v)) AS q
  FROM c JOIN (SELECT lang, sum(c) AS n FROM c GROUP BY lang) USING (lang) JOIN sizes USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""


def _escaped(column: str) -> str:
    steps = (("\\", "\\\\"), (chat.OPEN, chat.ESCAPE + chat.OPEN), (chat.CLOSE, chat.ESCAPE + chat.CLOSE))
    for old, new in steps:
        column = f"replace({column}, '{old}', '{new}')"
    return column


_LOSS = "coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')"

CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  length({_LOSS})::BIGINT AS loss_chars, sha256({_LOSS}) AS loss_sha256,
  sum(length('{chat.OPEN} : {chat.CLOSE}') + 1 + length(replace({_escaped('role')}, ':', '\\:')) + length({_escaped('text')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


def _drawn(group: int) -> str:
    return f"('0x' || substr(h, {8 * group + 1}, 8))::BIGINT"


_CONTAINS = " OR ".join(f"contains(t, '{m}')" for m in (middle.PREFIX, middle.SUFFIX, middle.MIDDLE))

MIDDLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{middle.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), cut AS (
  SELECT *, length(t)::BIGINT AS n, {_drawn(0)} % (length(t) + 1) AS a, {_drawn(1)} % (length(t) + 1) AS b FROM d
), formed AS (
  SELECT *, least(a, b) AS x, abs(a - b) AS y,
    CASE WHEN t = '' OR {_CONTAINS} OR {_drawn(2)} % 100 >= {middle.FIM_PERCENT} THEN 'plain'
      WHEN {_drawn(3)} % 100 < {middle.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), pieces AS (
  SELECT *, substr(t, 1, x) AS p, substr(t, x + 1, y) AS m, substr(t, x + y + 1) AS s FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN y END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{middle.PREFIX}' || p || '{middle.SUFFIX}' || s || '{middle.MIDDLE}' || m
    ELSE '{middle.SUFFIX}' || s || '{middle.PREFIX}' || p || '{middle.MIDDLE}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM pieces
"""
