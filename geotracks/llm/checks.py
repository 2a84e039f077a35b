"""Check SQL of this folder's queries, for DuckDB on the same tables.

Written from the meaning of each query. Those on all pairs or step by step are meant for small
scale factors. Queries without an entry are held to brute force in tests/llm.
"""

from __future__ import annotations

from geotracks.llm import credentials

_OP1 = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT parsed.*, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY parsed.page_id ORDER BY length(h || p) DESC NULLS LAST) AS n
  FROM parsed LEFT JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""

#: A word's CRC-32 modulo 10000: bytes are folded in bit by bit, once for each distinct word.
_CRC = """
  xor(list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(range(length(hex(w)) // 2), lambda i: ('0x' || substr(hex(w), 2 * i + 1, 2))::UBIGINT)),
    lambda c, b: list_reduce(
      list_concat([xor(c, b)], list_transform(range(8), lambda z: 0::UBIGINT)),
      lambda x, z: xor(x // 2, (x % 2) * 3988292384::UBIGINT)
    )
  ), 4294967295::UBIGINT)
"""

_OP12 = f"""
WITH texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
), words AS MATERIALIZED (
  SELECT side, r, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'
  )) AS w FROM texts
), buckets AS MATERIALIZED (
  SELECT w, ({_CRC}) % 10000 AS bucket FROM (SELECT DISTINCT w FROM words)
), sums AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM words JOIN buckets USING (w) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000)::DOUBLE)))::BIGINT AS gain FROM sums
), weights AS (
  SELECT r, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM words JOIN buckets USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT * FROM texts WHERE side = 'd') LEFT JOIN weights USING (r)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS eligible
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= eligible * 10 // 100 THEN place END AS rank FROM placed
"""



def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: str, pattern: str, group: int) -> str:
    text = _sql_text(pattern)
    return f"""SELECT r, '{kind}' AS kind, string_split_regex(t, {text}) AS parts, regexp_extract_all(t, {text}) AS whole,
      regexp_extract_all(t, {text}, {group}) AS vals FROM docs WHERE regexp_matches(t, {text})"""


_LOOKBEHIND = "(?<![0-9a-f])"  # a run is taken whole without it too
_CANDIDATES = " UNION ALL ".join(
    [_matches(k, p.replace(_LOOKBEHIND, ""), g) for k, (p, g, _) in credentials.PATTERNS.items()] + [_matches("form", credentials.FORMS, 0)]
)
_OP13 = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), found AS ({_CANDIDATES}
), numbered AS (
  SELECT r, kind, parts, whole, vals, unnest(range(1, len(whole) + 1)) AS i FROM found
), walked AS (
  SELECT r, kind, whole[i] AS m, vals[i] AS v, sum(length(parts[i]) + length(whole[i])) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM numbered
), valid AS MATERIALIZED (
  SELECT r, doc_id, source, kind, v, stop - length(m) AS start, stop FROM walked JOIN docs USING (r)
  WHERE kind = 'form' OR length(v) >= CASE kind WHEN 'assign' THEN 8 WHEN 'access' THEN 16 ELSE 32 END
), owned AS (
  SELECT v, count(DISTINCT {{'o': source}}) AS owners, count(DISTINCT {{'o': source, 'd': doc_id}}) AS repositories FROM valid GROUP BY v
), judged AS (
  SELECT r, v, stop, CASE WHEN owners >= 5 AND repositories >= 5 THEN 'copied'
    WHEN owners = 1 AND length(v) >= 12 AND regexp_matches(v, '[A-Za-z]') AND regexp_matches(v, '[0-9]')
      AND len(list_distinct(string_split(v, ''))) >= 6 AND NOT regexp_matches(v, {_sql_text(credentials.PLACEHOLDER)}) THEN 'live' END AS kind
  FROM valid JOIN owned USING (v)
), spans AS (
  SELECT r, kind, start, stop, true AS base FROM valid WHERE kind <> 'form'
  UNION ALL SELECT DISTINCT r, kind, stop - length(v), stop, false FROM judged WHERE kind IS NOT NULL
), ordered AS (
  SELECT *, list_position(['assign', 'access', 'hex', 'live', 'copied'], kind) AS k, kind || ':' || start || ':' || stop AS s FROM spans
), texts AS (
  SELECT r, count(*) FILTER (base AND kind = 'assign') AS n_assign, count(*) FILTER (base AND kind = 'access') AS n_access,
         count(*) FILTER (base AND kind = 'hex') AS n_hex, string_agg(s, ',' ORDER BY start, k) FILTER (base) AS base_spans,
         string_agg(s, ',' ORDER BY start, k, stop) AS spans FROM ordered GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN texts USING (r)
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# What a node reaches by links both ways, itself included: the least of it names its component.
_REACHED = """
reached AS (
  SELECT id, id AS other FROM nodes
  UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other
), components AS (
  SELECT id, min(other) AS component_id FROM reached GROUP BY id
)"""

_OP5 = f"""
WITH RECURSIVE usable AS MATERIALIZED (
  SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.id <> b.id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), nodes AS (SELECT vec_id AS id FROM embeddings
),{_REACHED}
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN components ON id = e.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = e.vec_id
"""

_OP7 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT DISTINCT doc_id AS id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM words
), sizes AS (SELECT id, count(*) AS n FROM sets GROUP BY id
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM sets x JOIN sets y USING (shingle) WHERE x.id <> y.id GROUP BY ALL)
  JOIN sizes s ON s.id = a JOIN sizes t ON t.id = b WHERE 100 * shared >= 75 * (s.n + t.n - shared)
), nodes AS (SELECT doc_id AS id FROM documents
),{_REACHED}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN components c ON c.id = d.doc_id LEFT JOIN sizes z ON z.id = d.doc_id
"""

# States: nothing yet 0, a system row 1, a user's 2, an assistant's 3. A row is put in at most
# twice in a row, as two lead anywhere.
_OP11 = f"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS w FROM conversations
), kinds AS MATERIALIZED (
  SELECT w, ({_CRC}) % 20 AS kind FROM (SELECT DISTINCT w FROM keyed)
), harmed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text
  FROM keyed JOIN kinds USING (w), (VALUES (1), (2)) c(copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i,
         regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS bare FROM harmed
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
), marked AS MATERIALIZED (SELECT *, coalesce(fault, '') IN ('blank', 'duplicate') AS must_go, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM faults
), steps(q, next, initial, full_role) AS (VALUES (0, 2, 'u', 'user'), (1, 2, 'u', 'user'), (2, 3, 'a', 'assistant'), (3, 2, 'u', 'user')
), fills AS (
  SELECT q, q AS q2, 0 AS n, '' AS lines FROM steps
  UNION ALL SELECT q, next, 1, chr(10) || full_role || ':' FROM steps
  UNION ALL SELECT s.q, t.next, 2, chr(10) || s.full_role || ':' || chr(10) || t.full_role || ':' FROM steps s JOIN steps t ON t.q = s.next
), best(conv_id, i, q, b) AS (
  SELECT c.conv_id, 0::BIGINT, f.q2, {{'cost': 3 * f.n, 'audit': repeat('I', f.n), 'lines': f.lines}}
  FROM (SELECT DISTINCT conv_id FROM marked) c, fills f WHERE f.q = 0
  UNION ALL
  SELECT conv_id, i, q2, min({{'cost': cost + 3 * n, 'audit': audit || repeat('I', n), 'lines': lines || more_lines}}) FROM (
    SELECT e.conv_id, e.i, f.q2, f.n, f.lines AS more_lines, e.cost, e.audit, e.lines FROM (
      SELECT m.conv_id, m.i, best.q AS q, best.b.cost + 4 AS cost, best.b.audit || 'D' AS audit, best.b.lines AS lines
      FROM best JOIN marked m ON m.conv_id IS NOT DISTINCT FROM best.conv_id AND m.i = best.i + 1
      UNION ALL
      SELECT m.conv_id, m.i, CASE m.r WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, best.b.cost + m.more, best.b.audit || 'K', best.b.lines || chr(10) || m.role || ':' || m.text
      FROM best JOIN marked m ON m.conv_id IS NOT DISTINCT FROM best.conv_id AND m.i = best.i + 1 JOIN steps s ON s.q = best.q
      WHERE NOT m.must_go AND (m.r = s.initial OR (m.r = 's' AND best.q = 0))
      UNION ALL
      SELECT m.conv_id, m.i, s.next, best.b.cost + m.more + 3, best.b.audit || 'R', best.b.lines || chr(10) || s.full_role || ':' || m.text
      FROM best JOIN marked m ON m.conv_id IS NOT DISTINCT FROM best.conv_id AND m.i = best.i + 1 JOIN steps s ON s.q = best.q
      WHERE NOT m.must_go
    ) e JOIN fills f ON f.q = e.q
  ) GROUP BY conv_id, i, q2
), ends AS (
  SELECT conv_id, min(b) AS b FROM best
  WHERE q IN (0, 3) AND i = (SELECT max(m.i) FROM marked m WHERE m.conv_id IS NOT DISTINCT FROM best.conv_id) GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.b.cost, 0)::BIGINT AS cost, coalesce(e.b.audit, '') AS audit,
       sha256(coalesce(substr(e.b.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

CHECKS: dict[str, str] = {
    "op1_url_filters": _OP1,
    "op5_sorted_projection_dedup": _OP5,
    "op7_bottom_k_near_dedup": _OP7,
    "op11_block_table_repair": _OP11,
    "op12_regular_sampling_resampling": _OP12,
    "op13_ownership_secret_scan": _OP13,
}
