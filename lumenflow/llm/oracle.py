"""DuckDB statements of the numbered queries that SQL can express at a bearable cost."""

from __future__ import annotations

OP1 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(hex, 1 + 5 * i // 4, 2) AS BIGINT) >> CAST(3 - 5 * i % 4 AS BIGINT)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads
"""

OP4 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM words, unnest(range(1, len(w) - 11)) AS t(i)
), owners AS (
  SELECT k, min(doc_id) AS owner FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN owners USING (k) WHERE owner < doc_id
), left_over AS (
  SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS kept, count(*) AS n
  FROM (SELECT doc_id, w, i FROM words, unnest(range(1, len(w) + 1)) AS t(i)) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
"""

OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM words, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS t(i)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id < b.doc_id
  JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS root FROM documents
  UNION
  SELECT l.y, r.root FROM reach r JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON l.x = r.x
), components AS (
  SELECT x AS doc_id, min(root) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

OP11 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS code
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.code, d.code) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP13 = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), drawn AS (
  SELECT *, xor(list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x // 2, (x % 2) * 3988292384))
    ), 4294967295) % 20 AS draw
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN draw = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn WHERE draw <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 3
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 1 ELSE 0 END AS fault,
         substr(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1, 1) || substr(role, 1, 1) AS pair
  FROM numbered
), gathered AS (
  SELECT conv_id, list({'ini': substr(role, 1, 1), 'role': role, 'text': text, 'fault': fault} ORDER BY i) AS m,
         count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM judged GROUP BY conv_id
), steps AS (
  SELECT conv_id, len(m) AS i, {'c': 0, 's': '', 'r': ''} AS s, {'c': 6, 's': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'} AS y,
         {'c': 3, 's': 'I', 'r': chr(10) || 'assistant:'} AS u, {'c': 0, 's': '', 'r': ''} AS a
  FROM gathered
  UNION ALL
  SELECT conv_id, i,
         list_sort([s, {'c': 3 + u2.c, 's': 'I' || u2.s, 'r': chr(10) || 'user:' || u2.r}])[1],
         list_sort([y, {'c': 3 + u2.c, 's': 'I' || u2.s, 'r': chr(10) || 'user:' || u2.r}])[1],
         u2, a2
  FROM (
    SELECT conv_id, i, s, y,
           list_sort([u, {'c': 3 + a.c, 's': 'I' || a.s, 'r': chr(10) || 'assistant:' || a.r}])[1] AS u2,
           list_sort([a, {'c': 3 + u.c, 's': 'I' || u.s, 'r': chr(10) || 'user:' || u.r}])[1] AS a2
    FROM (
      SELECT conv_id, i - 1 AS i,
             list_sort([d_s, CASE x.ini WHEN 's' THEN {'c': t + y.c, 's': 'K' || y.s, 'r': line || y.r} WHEN 'u' THEN {'c': t + u.c, 's': 'K' || u.s, 'r': line || u.r} ELSE d_s END, to_u])[1] AS s,
             list_sort([d_y, CASE x.ini WHEN 'u' THEN {'c': t + u.c, 's': 'K' || u.s, 'r': line || u.r} ELSE d_y END, to_u])[1] AS y,
             list_sort([d_u, CASE x.ini WHEN 'a' THEN {'c': t + a.c, 's': 'K' || a.s, 'r': line || a.r} ELSE d_u END,
                        {'c': 3 + t + a.c, 's': 'R' || a.s, 'r': chr(10) || 'assistant:' || x.text || a.r}])[1] AS u,
             list_sort([d_a, CASE x.ini WHEN 'u' THEN {'c': t + u.c, 's': 'K' || u.s, 'r': line || u.r} ELSE d_a END, to_u])[1] AS a
      FROM (
        SELECT *, {'c': 4 + s.c, 's': 'D' || s.s, 'r': s.r} AS d_s, {'c': 4 + y.c, 's': 'D' || y.s, 'r': y.r} AS d_y,
               {'c': 4 + u.c, 's': 'D' || u.s, 'r': u.r} AS d_u, {'c': 4 + a.c, 's': 'D' || a.s, 'r': a.r} AS d_a,
               {'c': 3 + t + u.c, 's': 'R' || u.s, 'r': chr(10) || 'user:' || x.text || u.r} AS to_u, chr(10) || x.role || ':' || x.text AS line
        FROM (
          SELECT p.*, g.m[p.i] AS x, CASE g.m[p.i].fault WHEN 0 THEN 0 WHEN 1 THEN 3 ELSE 1000000 END AS t
          FROM steps p JOIN gathered g ON g.conv_id IS NOT DISTINCT FROM p.conv_id
          WHERE p.i > 0
        )
      )
    )
  )
), solved AS (SELECT conv_id, s FROM steps WHERE i = 0),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, CAST(coalesce(g.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(g.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(g.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(g.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(g.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(v.s.c, 0) AS BIGINT) AS cost,
       coalesce(v.s.s, '') AS audit, sha256(coalesce(substr(v.s.r, 2), '')) AS repaired_sha256
FROM every e LEFT JOIN gathered g ON g.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN solved v ON v.conv_id IS NOT DISTINCT FROM e.conv_id
"""

STATEMENTS = {
    "op1_warc_revisits": OP1,
    "op4_fm_index_dedup": OP4,
    "op6_minmax_near_dedup": OP6,
    "op11_block_max_top_k": OP11,
    "op12_fill_in_middle": OP12,
    "op13_conversation_repair": OP13,
}
