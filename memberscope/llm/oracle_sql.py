"""DuckDB SQL of the newer operators' queries."""

from __future__ import annotations

#: Operator 11. The repair is a least-cost walk over four places (n nothing
#: read, s, u, a the last role); a place holds (cost, audit, repaired text).
REPAIR_SQL = r"""
WITH RECURSIVE src AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
hit AS (
  SELECT *, CAST(xor(list_reduce(list_transform(string_split(key, ''), lambda ch: CAST(ord(ch) AS BIGINT)),
    lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, k:
      CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, xor(crc, b)),
    CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 20 AS INTEGER) AS kind FROM src),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, LATERAL (SELECT unnest(CASE kind WHEN 3 THEN [0, 1] WHEN 0 THEN [] ELSE [0] END)) AS copies),
convs AS (SELECT DISTINCT conv_id FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown FROM damaged),
faulty AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) AS i FROM placed),
neighbours AS (
  SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY pos) AS was, pos > 1 AS follows FROM faulty),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, {'c': 0, 'a': '', 't': ''} AS n, {'c': 1000000, 'a': '', 't': ''} AS s,
         {'c': 5, 'a': 'I', 't': chr(10) || 'user:'} AS u,
         {'c': 10, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS a
  FROM convs
  UNION ALL
  SELECT conv_id, pos, n, s, u2,
         least(a1, {'c': u2.c + 5, 'a': u2.a || 'I', 't': u2.t || chr(10) || 'assistant:'})
  FROM (
    SELECT *, least(u1, {'c': n.c + 5, 'a': n.a || 'I', 't': n.t || chr(10) || 'user:'},
                    {'c': s.c + 5, 'a': s.a || 'I', 't': s.t || chr(10) || 'user:'},
                    {'c': a1.c + 5, 'a': a1.a || 'I', 't': a1.t || chr(10) || 'user:'}) AS u2
    FROM (
      SELECT f.conv_id, f.pos, {'c': w.n.c + 2, 'a': w.n.a || 'D', 't': w.n.t} AS n,
        least({'c': w.s.c + 2, 'a': w.s.a || 'D', 't': w.s.t},
          CASE WHEN d OR i <> 's' THEN {'c': 1000000, 'a': '', 't': ''}
               ELSE {'c': w.n.c + x, 'a': w.n.a || 'K', 't': w.n.t || chr(10) || o} END) AS s,
        least({'c': w.u.c + 2, 'a': w.u.a || 'D', 't': w.u.t},
          CASE WHEN d THEN {'c': 1000000, 'a': '', 't': ''}
               WHEN i = 'u' THEN {'c': least(w.n, w.s, w.a).c + x, 'a': least(w.n, w.s, w.a).a || 'K',
                                  't': least(w.n, w.s, w.a).t || chr(10) || o}
               ELSE {'c': least(w.n, w.s, w.a).c + x + 1, 'a': least(w.n, w.s, w.a).a || 'R',
                     't': least(w.n, w.s, w.a).t || chr(10) || 'user:' || f.text} END) AS u1,
        least({'c': w.a.c + 2, 'a': w.a.a || 'D', 't': w.a.t},
          CASE WHEN d THEN {'c': 1000000, 'a': '', 't': ''}
               WHEN i = 'a' THEN {'c': w.u.c + x, 'a': w.u.a || 'K', 't': w.u.t || chr(10) || o}
               ELSE {'c': w.u.c + x + 1, 'a': w.u.a || 'R',
                     't': w.u.t || chr(10) || 'assistant:' || f.text} END) AS a1
      FROM walk w JOIN (
        SELECT *, fault IN ('blank', 'duplicate') AS d, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS x,
               role || ':' || text AS o FROM faulty) f
        ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1))),
ends AS (
  SELECT conv_id, least(n, a) AS best FROM walk
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (follows AND was || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM neighbours GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
       sha256(substr(best.t, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

#: Operator 12.
SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
n AS (SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
items AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
wanted AS (SELECT q, unnest(terms) AS term FROM items),
tf AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY rid, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
m AS (SELECT rid, doc_id, 100 - 50 + (50 * n * docs) // terms AS m FROM n, total),
gain AS (
  SELECT tf.rid, m.doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS g
  FROM tf JOIN m USING (rid) JOIN w USING (term)),
scored AS (
  SELECT q, rid, any_value(doc_id) AS doc_id, CAST(sum(g) AS BIGINT) AS score
  FROM wanted JOIN gain USING (term) GROUP BY q, rid HAVING sum(g) > 0),
ranked AS (
  SELECT q, doc_id, score,
         row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS r FROM scored)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (q) WHERE r <= 50
"""
