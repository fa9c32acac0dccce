"""The queries that SQL can express, in DuckDB's."""

from __future__ import annotations

SQL = {}

SQL["op3_chat_formatting"] = r"""
WITH said AS (
  SELECT conv_id, turn AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), pieces AS (
  SELECT *, '<|im_start|>' || regexp_replace(role, control, '\1\2\\\3', 'g') || '<|im_sep|>'
         || regexp_replace(text, control, '\1\2\\\3', 'g') || '<|im_end|>' || chr(10) AS piece
  FROM said, (SELECT '([<\[])(\\*)(<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|im_sep\|>'
              || '|\|endoftext\|>|\|system\|>|\|user\|>|\|assistant\|>|s>|/s>|INST\]|/INST\])'
              AS control)
), counted AS (
  SELECT *, len(regexp_extract_all(piece, '[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]')) AS tokens
  FROM pieces
), summed AS (
  SELECT *, sum(tokens) OVER w AS b, row_number() OVER w AS n,
         row_number() OVER (PARTITION BY conv_id, role ORDER BY pos, text) AS of_role
  FROM counted WINDOW w AS (PARTITION BY conv_id ORDER BY pos, role, text
                            ROWS UNBOUNDED PRECEDING)
), strided AS (
  SELECT *, b - tokens AS a, role = 'system' AND of_role = 1 AS retained,
         greatest(256, 2048 - 512 - coalesce(max(CASE WHEN role = 'system' AND of_role = 1
           THEN tokens END) OVER (PARTITION BY conv_id), 0)) AS stride
  FROM summed
), placed AS (
  SELECT *, floor(a / stride) AS cell, floor((b - 1) / stride) != floor(a / stride) AS alone
  FROM strided
), wins AS (
  SELECT conv_id, cell, alone, min(a) AS start FROM placed GROUP BY ALL
), chars AS (
  SELECT conv_id, sum(length(piece)) AS n FROM placed GROUP BY ALL
  UNION ALL
  SELECT p.conv_id, sum(length(piece)) FROM placed p JOIN wins w
    ON p.conv_id = w.conv_id AND p.retained AND w.start > p.a GROUP BY ALL
  UNION ALL
  SELECT p.conv_id, sum(length(piece)) FROM placed p JOIN wins w
    ON p.conv_id = w.conv_id AND NOT p.retained AND w.start BETWEEN p.b AND p.a + 512
  GROUP BY ALL
), formatted AS (
  SELECT conv_id, sum(n) AS n FROM chars GROUP BY ALL
)
SELECT s.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       any_value(f.n)::BIGINT AS formatted_chars
FROM said s JOIN formatted f ON s.conv_id IS NOT DISTINCT FROM f.conv_id
GROUP BY s.conv_id
"""

SQL["op10_warc_records"] = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS n FROM pages
), r AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS leader FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT)
           >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN leader = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN leader != page_id THEN leader END AS refers_to
FROM r
"""

SQL["op2_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN ['no words: ' || t]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3),
           lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s
  FROM words
), classes AS MATERIALIZED (
  SELECT row_number() OVER () AS rep, count(*) AS size, len(s) AS n, s FROM sets GROUP BY s
), owned AS (
  SELECT doc_id FROM sets GROUP BY doc_id HAVING count(DISTINCT s) = 1
), names AS (
  SELECT rep, min(sets.doc_id) AS least, min(owned.doc_id) AS own
  FROM sets JOIN classes USING (s) LEFT JOIN owned ON owned.doc_id = sets.doc_id GROUP BY rep
), one AS (
  SELECT rep, size, n, unnest(s) AS g FROM classes
), pairs AS (
  SELECT x.rep AS a, y.rep AS b, y.size AS size
  FROM one x JOIN one y ON x.g = y.g AND x.rep != y.rep
  GROUP BY x.rep, y.rep, x.n, y.n, y.size
  HAVING count(*) >= 0.8 * (x.n + y.n - count(*)) - 1e-9
), reached AS (
  SELECT rep AS node, rep AS other FROM classes
  UNION
  SELECT r.node, p.b FROM reached r JOIN pairs p ON r.other = p.a
), grouped AS (
  SELECT node, coalesce(min(own), min(least)) AS group_id
  FROM reached JOIN names ON other = rep GROUP BY node
), linked AS (
  SELECT a, sum(size) AS n FROM pairs GROUP BY a
)
SELECT doc_id, coalesce(own, least) AS class_id,
       (size - 1 + coalesce(l.n, 0))::BIGINT AS n_links, group_id
FROM sets JOIN classes USING (s) JOIN names USING (rep) JOIN grouped ON node = rep
LEFT JOIN linked l ON l.a = rep
"""


def _clusters() -> str:
    """Assignments and means of every round, each a step of its own."""
    steps = [r"""
WITH vectors AS (
  SELECT row_number() OVER () AS id, vec_id, x FROM (
    SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = 64
      AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64)
), centers0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1 AS c, x AS m
  FROM vectors QUALIFY c < 16
)"""]
    for r in range(4):
        steps.append(f""", apart{r} AS (
  SELECT id, c, list_sum(list_transform(range(1, 65),
           lambda i: ((x[i] - m[i]) * (x[i] - m[i]))::HUGEINT)) AS d
  FROM vectors, centers{r}
), placed{r} AS (
  SELECT id, arg_min(c, (d, c)) AS c, min(d) AS d FROM apart{r} GROUP BY id
)""")
        if r < 3:
            steps.append(f""", entries{r} AS (
  SELECT c, i, sum(x[i])::HUGEINT AS s, count(*) AS n
  FROM placed{r} JOIN vectors USING (id), (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i
), means{r} AS (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM entries{r} GROUP BY c
), centers{r + 1} AS (
  SELECT c, coalesce(n.m, o.m) AS m FROM centers{r} o LEFT JOIN means{r} n USING (c)
)""")
    return "".join(steps) + """
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance,
       (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM placed3 JOIN vectors USING (id) JOIN centers3 USING (c)
"""


SQL["op12_centroid_clustering"] = _clusters()
