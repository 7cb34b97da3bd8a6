"""DuckDB SQL for the queries that SQL can express, from the definitions alone."""

_WORDS = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The words of every document, numbered from 1.
_DOC_WORDS = f"""
docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM docs)"""

SUBSTRING = f"""
WITH {_DOC_WORDS},
windows AS (
  SELECT doc_id, i AS pos, ws[i:i + 19] AS win
  FROM docs, unnest(range(1, greatest(len(ws) - 18, 1))) AS t(i) WHERE len(ws) >= 20),
ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM windows),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM ranked WHERE nth > 1),
kept AS (
  SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.pos) AS text, count(*) AS n
  FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos GROUP BY w.doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, len(d.ws) - coalesce(k.n, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)"""

LEAKS = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_PLAIN}') AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_PLAIN}') AS ws FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, ws[i:i + 9] AS win
  FROM items, unnest(range(1, greatest(len(ws) - 8, 2))) AS t(i) WHERE len(ws) > 0),
lengths AS (SELECT DISTINCT n FROM patterns),
found AS (
  SELECT d.doc_id, d.i AS pos, p.n, p.item_id
  FROM (SELECT doc_id, n, i, ws[i:i + n - 1] AS win
        FROM docs, lengths, unnest(range(1, greatest(len(ws) - n + 2, 1))) AS t(i)) d
  JOIN patterns p ON p.n = d.n AND p.win = d.win),
hits AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN named n USING (doc_id)"""

LINES = r"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
windows AS (
  SELECT doc_id, i AS pos, ls[i:i + 2] AS win
  FROM docs, unnest(range(1, greatest(len(ls) - 1, 1))) AS t(i)
  WHERE regexp_matches(array_to_string(ls[i:i + 2], ''), '[^\x20\x09-\x0D]')),
ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM ranked WHERE nth > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text, count(*) AS n
  FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(len(d.ls), 0) AS n_lines, coalesce(len(d.ls), 0) - coalesce(k.n, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM docs d LEFT JOIN kept k USING (doc_id)"""


def quality(rules, stop_words: list[str], symbols: str) -> str:
    """The facts and the rule table of ``quality_rules``, with windows compared as lists."""
    stops = ", ".join(f"'{w}'" for w in stop_words)
    value = [
        f"CAST({r.fact} AS DOUBLE)" if r.over is None else f"({r.fact}::DOUBLE / greatest({r.over}, 1))" for r in rules
    ]
    verdict = " AND ".join(f"{v} BETWEEN {r.least} AND {r.most}" for v, r in zip(value, rules))
    return f"""
WITH {_DOC_WORDS},
windows AS (
  SELECT doc_id, i AS pos, ws[i:i + 4] AS win
  FROM docs, unnest(range(1, greatest(len(ws) - 3, 1))) AS t(i) WHERE len(ws) >= 5),
repeated AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + 5)) AS pos FROM repeated) GROUP BY doc_id),
lines AS (
  SELECT doc_id, text, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
facts AS (
  SELECT d.doc_id, len(d.ws) AS n_words,
    length(array_to_string(d.ws, '')) AS word_chars,
    length(regexp_replace(array_to_string(d.ws, ''), '[^{symbols}]', '', 'g')) AS n_symbols,
    len(l.ls) - len(list_distinct(l.ls)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words,
    len(l.ls) AS n_lines,
    len(list_filter(d.ws, lambda w: lower(w) IN ({stops}))) AS n_stop_words,
    len(list_filter(l.ls, lambda x: ltrim(x)[1] IN ('-', '*', '•'))) AS n_bullet_lines,
    len(list_filter(l.ls, lambda x: suffix(rtrim(x), '...') OR suffix(rtrim(x), '…'))) AS n_ellipsis_lines,
    length(regexp_replace(array_to_string(d.ws, ''), '[^\\p{{L}}]+', '', 'g')) AS n_letters
  FROM docs d JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {verdict} AS kept
FROM facts"""


NEAR = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORDS}') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) >= 2
    THEN list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i:i + 1])) WHEN len(ws) = 1 THEN [ws] ELSE [] END AS s
  FROM docs),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS to_id FROM sets
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.to_id)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)"""
