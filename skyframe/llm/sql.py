"""DuckDB statements for the queries that SQL can express, written from the
contracts rather than from the Spark code."""

from __future__ import annotations

# The patterns of the contract; runs are written with their
# least length.
_PATTERNS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "AKIA[A-Z0-9]{16,}"), ("hex", "[0-9a-f]{24,}"), ("entropy", "[A-Za-z0-9+/_=-]{20,}"))


def _spans(k: int) -> str:
    """Spans of pattern ``k`` per text: pieces between matches give the places."""
    kind, pattern = _PATTERNS[k]
    p = pattern.replace("'", "''")
    return f"""{kind}_hits AS (
  SELECT row, regexp_extract_all(text, '{p}') AS hits, regexp_split_to_array(text, '{p}') AS gaps FROM t
  WHERE regexp_matches(text, '{p}')),
{kind}_at AS (
  SELECT row, hits[i] AS hit, {k} AS kind,
         CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
              + COALESCE(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM {kind}_hits))"""


ORACLE: dict[str, str] = {"op7_secret_scan": f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, COALESCE(text, '') AS text FROM documents),
{", ".join(_spans(k) for k in range(4))},
base AS (
  SELECT row, kind, s, s + length(hit) AS e FROM assign_at
  WHERE length(regexp_extract(hit, '{_PATTERNS[0][1].replace("'", "''")}', 1)) >= 6
  UNION ALL SELECT row, kind, s, s + length(hit) FROM access_at
  UNION ALL SELECT row, kind, s, s + length(hit) FROM hex_at),
-- candidates without what base spans cover: a piece starts with the candidate or where a span ends
starts AS (
  SELECT row, s AS c, s + length(hit) AS c_end, hit, s FROM entropy_at
  UNION SELECT c.row, c.s, c.s + length(c.hit), c.hit, b.e FROM entropy_at c
  JOIN base b ON b.row = c.row AND b.e > c.s AND b.e < c.s + length(c.hit)),
ends AS (
  SELECT x.row, x.c, x.hit, x.s, LEAST(x.c_end, COALESCE(MIN(b.s) FILTER (WHERE b.s >= x.s), x.c_end)) AS e
  FROM starts x LEFT JOIN base b ON b.row = x.row
  GROUP BY x.row, x.c, x.c_end, x.hit, x.s
  HAVING COUNT(*) FILTER (WHERE b.s <= x.s AND x.s < b.e) = 0),
pieces AS (
  SELECT row, 3 AS kind, s, e, hit[s - c + 1:e - c] AS hit FROM ends WHERE e - s >= 20),
bits AS (
  SELECT row, kind, s, e, hit,
         list_max(list_transform(range(1, length(hit) - 18), lambda i: list_sum(list_transform(
           list_distinct(string_split(hit[i:i + 19], '')), lambda c:
           -(20 - length(replace(hit[i:i + 19], c, ''))) / 20.0 * log2((20 - length(replace(hit[i:i + 19], c, ''))) / 20.0)
         )))) AS h
  FROM pieces
  WHERE regexp_matches(hit, '[0-9]') AND NOT regexp_full_match(hit, '[0-9_=+/-]+')
    AND NOT regexp_full_match(hit, '[0-9A-Fa-f]{{8}}-[0-9A-Fa-f]{{4}}-[0-9A-Fa-f]{{4}}-[0-9A-Fa-f]{{4}}-[0-9A-Fa-f]{{12}}')
    AND NOT regexp_matches(hit, '(?i:example|sample|placeholder|xxxxxx)')
    AND NOT list_contains(list_transform(range(1, length(hit) - 8),
                                         lambda i: hit[i:i + 9] = repeat(hit[i:i], 10)), true)),
extra AS (
  SELECT row, kind, s, e FROM bits
  WHERE h >= CASE WHEN regexp_full_match(hit, '[0-9A-Fa-f]+') THEN 3.0
                  WHEN regexp_full_match(hit, '[A-Z0-9]+') THEN 3.4 ELSE 3.7 END),
b AS (
  SELECT row, COUNT(*) FILTER (WHERE kind = 0) AS n_assign, COUNT(*) FILTER (WHERE kind = 1) AS n_access,
         COUNT(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS listed
  FROM base GROUP BY row),
a AS (
  SELECT row, string_agg(['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind)
           AS listed
  FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY row)
SELECT t.doc_id, COALESCE(b.n_assign, 0) AS n_assign, COALESCE(b.n_access, 0) AS n_access,
       COALESCE(b.n_hex, 0) AS n_hex, sha256(COALESCE(b.listed, '')) AS base_sha256, COALESCE(a.listed, '') AS spans
FROM t LEFT JOIN b ON t.row = b.row LEFT JOIN a ON t.row = a.row"""}

# crc32 by its rule: the table of all bytes, then byte by byte.
_CRC = """tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab)"""


def _crc32(s: str) -> str:
    return f"""xor(4294967295, list_reduce(list_transform(range(strlen({s})), lambda i:
      CAST('0x' || hex(encode({s}))[2 * i + 1:2 * i + 2] AS BIGINT)),
      lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1]), 4294967295))"""


ORACLE["op12_spelling_variants"] = f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]{{5,}}')) AS run
  FROM documents),
counted AS (SELECT id, run, COUNT(*) AS k FROM runs GROUP BY id, run),
hashed AS (SELECT run, k, {_crc32("(id || ':' || run)")} AS h FROM counted, tab),
vocabulary AS (
  SELECT word, CAST(SUM(k) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k
        FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING SUM(k) >= 3),
gaps AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest
         FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM gaps x JOIN gaps y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM vocabulary x JOIN gaps y ON x.word = y.rest
  UNION SELECT y.word, y.n, x.word, x.n FROM vocabulary x JOIN gaps y ON x.word = y.rest),
best AS (
  SELECT word, COUNT(*) AS n_near, MAX(other_n) AS top_n, arg_min(other, (-other_n, encode(other))) AS top
  FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, COALESCE(b.n_near, 0) AS n_near,
         CASE WHEN b.top_n >= 2 * v.n THEN b.top END AS form, CASE WHEN b.top_n >= 2 * v.n THEN b.top_n END AS form_n
  FROM vocabulary v LEFT JOIN best b ON v.word = b.word),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON w.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w ON f.word = w.word JOIN forms e ON w.at = e.word AND e.form IS NULL"""

ORACLE["op13_hard_negatives"] = """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
s AS (
  SELECT a.id AS anchor, c.id AS other, a.label = c.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.vec) + 1), lambda i: a.vec[i] * c.vec[i])) AS BIGINT) AS score
  FROM r a JOIN r c ON a.id <> c.id WHERE a.id % 50 = 0),
p AS (
  SELECT anchor, other AS positive, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.anchor, p.positive, p.score AS positive_score, s.other, s.score,
         row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
   AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(rank AS INTEGER) AS rank, other AS negative_id,
       positive_score, score AS negative_score
FROM n WHERE rank <= 3"""
