"""The same results in SQL for another engine, where SQL can tell them."""

from __future__ import annotations

import string

from evpipe.llm.licenses import TEMPLATES, THRESHOLD
from evpipe.llm.line_dedup import LEAST_WORDS

_SPACE = r"[^\x20\x09-\x0D]+"
_LETTER = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce({0}, ''), '" + string.ascii_uppercase + "', '" + string.ascii_lowercase + "')"


def _words(text: str, pattern: str, fold: bool) -> str:
    return f"regexp_extract_all({_LOWER.format(text) if fold else f'coalesce({text}, {chr(39) * 2})'}, '{pattern}')"


DECONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_words('text', _LETTER, True)} AS ws FROM documents),
b AS (SELECT item_id, {_words('text', _LETTER, True)} AS ws FROM benchmark),
bw AS MATERIALIZED (SELECT DISTINCT item_id, least(len(ws), 10) AS n,
    array_to_string(list_slice(ws, i, i + 9), ' ') AS k
  FROM b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) t(i) WHERE len(ws) > 0),
dw AS (SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS k
  FROM (SELECT * FROM d, (SELECT DISTINCT n FROM bw)), unnest(range(1, len(ws) - n + 2)) t(i)),
hits AS MATERIALIZED (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, k)),
pos AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hits, unnest(range(n)) t(o) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN found USING (doc_id)"""

NEAR = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_words('text', _SPACE, True)} AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
  FROM d, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) t(i) WHERE len(ws) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
root AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN root USING (doc_id)"""

SUBSTRINGS = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_words('text', _SPACE, False)} AS ws FROM documents),
g AS MATERIALIZED (SELECT doc_id, i, sha256(array_to_string(list_slice(ws, i, i + 34), ' ')) AS k
  FROM d, unnest(range(1, len(ws) - 33)) t(i)),
hit AS (SELECT doc_id, i FROM g JOIN (SELECT k FROM g GROUP BY k HAVING count(*) > 1) USING (k)),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, i + o AS i FROM hit, unnest(range(35)) t(o)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, i, ws[i] AS w FROM d, unnest(range(1, len(ws) + 1)) t(i))
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

NEAREST = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
    FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)))
WHERE rk <= 5"""

LINES = f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
l AS MATERIALIZED (SELECT doc_id, i - 1 AS line, ws, array_to_string(ws, ' ') AS s
  FROM (SELECT doc_id, i, regexp_extract_all(p[i], '{_SPACE}') AS ws
    FROM parts, unnest(range(1, len(p) + 1)) t(i)) WHERE len(ws) > 0),
o AS MATERIALIZED (SELECT s, any_value(ws) AS ws, min(place) AS first
  FROM (SELECT *, row_number() OVER (ORDER BY doc_id, line) AS place FROM l) GROUP BY s),
v AS MATERIALIZED (SELECT s, first, i,
    CASE WHEN i = 0 THEN s ELSE array_to_string(list_concat(list_slice(ws, 1, i - 1), list_slice(ws, i + 1, len(ws))), ' ') END AS k
  FROM o, unnest(range(0, len(ws) + 1)) t(i) WHERE len(ws) >= {LEAST_WORDS}),
same AS (SELECT k, i, min(first) AS e FROM v WHERE i > 0 GROUP BY k, i),
whole AS (SELECT k, first AS e FROM v WHERE i = 0),
less AS (SELECT k, min(first) AS e FROM v WHERE i > 0 GROUP BY k),
near AS (SELECT v.s FROM v JOIN same USING (k, i) WHERE e < first
  UNION SELECT v.s FROM v JOIN whole USING (k) WHERE v.i > 0 AND e < first
  UNION SELECT v.s FROM v JOIN less USING (k) WHERE v.i = 0 AND e < first),
judged AS (SELECT doc_id, line, place <> o.first OR l.s IN (SELECT s FROM near) AS gone
  FROM (SELECT *, row_number() OVER (ORDER BY doc_id, line) AS place FROM l) l JOIN o ON o.s = l.s)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(lines, '')) AS removed_sha256
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    string_agg(CASE WHEN gone THEN CAST(line AS VARCHAR) END, ',' ORDER BY line) AS lines
  FROM judged GROUP BY doc_id) USING (doc_id)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _bigrams(words: str) -> str:
    return (f"CASE WHEN len({words}) = 1 THEN {words} ELSE list_distinct([{words}[i] || ' ' || {words}[i + 1] "
            f"for i in range(1, len({words}))]) END")


LICENSES = f"""
WITH t AS (SELECT license_id, {_bigrams('ws')} AS g FROM (SELECT license_id, {_words('text', _LETTER, True)} AS ws
    FROM (VALUES {', '.join(f'({_quoted(k)}, {_quoted(v)})' for k, v in TEMPLATES.items())}) x(license_id, text))),
parts AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
units AS (SELECT doc_id, i AS line, {_words('p[i]', _LETTER, True)} AS ws
    FROM parts, unnest(range(1, len(p) + 1)) x(i)
  UNION ALL SELECT doc_id, 0, {_words('text', _LETTER, True)} FROM parts),
u AS MATERIALIZED (SELECT doc_id, line, {_bigrams('ws')} AS g FROM units WHERE len(ws) > 0),
m AS (SELECT doc_id, line, license_id, 2.0::DOUBLE * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) AS dice
  FROM u JOIN t ON len(u.g) <= (2 - {THRESHOLD}) / {THRESHOLD} * len(t.g) + 1e-9
    AND len(u.g) >= {THRESHOLD} / (2 - {THRESHOLD}) * len(t.g) - 1e-9),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license_id) AS rk
  FROM m WHERE dice >= {THRESHOLD}),
top AS (SELECT doc_id, count(*) FILTER (line > 0) AS n_lines,
    arg_min(license_id, {{'d': -dice, 'n': license_id}}) AS license_id, max(dice) AS dice
  FROM best WHERE rk = 1 GROUP BY doc_id)
SELECT doc_id, license_id, round(dice, 9) AS dice, coalesce(n_lines, 0) AS n_lines
FROM documents LEFT JOIN top USING (doc_id)"""

COLLOCATIONS = r"""
with piece as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) as x
    from documents
), words as (
    select lang, regexp_extract_all(x, '[^\x20\x09]+') as w from piece
), gram as (
    select lang, k as size, array_to_string(w[i : i + k - 1], ' ') as phrase
    from words, unnest([1, 2, 3, 4]) as sizes(k), unnest(range(1, len(w) - k + 2)) as places(i)
), f as (
    select lang, size, phrase, string_split(phrase, ' ') as w, count(*)::hugeint as a
    from gram group by all
), total as (
    select lang, sum(a)::bigint as n from f where size = 1 group by lang
), often as (
    select * from f where a >= 30
), cut as (
    select c.lang, c.size, c.phrase, c.a, k, l.a as l, r.a as r, 2000000 * c.a // (l.a + r.a) as score
    from often c, unnest(range(1, c.size)) as places(k)
    join often l on l.lang = c.lang and l.phrase = array_to_string(c.w[1 : k], ' ')
    join often r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1 :], ' ')
), worst as (
    select * from cut qualify row_number() over (partition by lang, phrase order by score, k) = 1
), part as (
    select p.lang, array_to_string(p.w[i : i + k - 1], ' ') as phrase, max(p.a) as a
    from often p, unnest([2, 3]) as sizes(k), unnest(range(1, p.size - k + 2)) as places(i)
    where k < p.size group by all
), kept as (
    select w.* from worst w left join part p on p.lang = w.lang and p.phrase = w.phrase
    where p.a is null or 100 * p.a < 80 * w.a
)
select * from (
    select k.lang, row_number() over (
        partition by k.lang order by k.score desc, k.a desc, k.phrase) as rank,
        k.phrase, k.a::bigint as a, k.l::bigint as l, k.r::bigint as r, t.n, k.score::bigint as score
    from kept k join total t on t.lang = k.lang
) where rank <= 2000
"""
