"""DuckDB SQL for the operators' queries, where SQL can express them."""

ORACLE = {}

ORACLE["op1_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no
  FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((no - 1) % 3) + 1] AS w, 2 * source_size AS cap FROM s),
r AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget,
         coalesce(sum(cap) OVER b, 0)::DOUBLE AS cap_before,
         (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS w_left
  FROM w WINDOW b AS (ORDER BY cap::DOUBLE / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, cap <= (budget - cap_before) / w_left * w AS limited FROM r),
t AS (
  SELECT source, no, source_size, CASE WHEN limited THEN cap::DOUBLE ELSE
    (budget - coalesce(sum(cap) FILTER (limited) OVER (), 0)::DOUBLE) / (sum(w) FILTER (NOT limited) OVER ())::DOUBLE * w END AS target
  FROM l),
q AS (
  SELECT d.*, t.no, t.source_size, t.target, row_number() OVER () AS id,
         (sum(size) OVER (PARTITION BY t.no ORDER BY k, size ROWS UNBOUNDED PRECEDING))::BIGINT AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT id, size, sum(size) OVER (ORDER BY (c * source_size + cum)::DOUBLE / target, no, c, k, size ROWS UNBOUNDED PRECEDING) AS served
  FROM q, (VALUES (0), (1)) AS v(c) WHERE size > 0),
g AS (SELECT id, sum(size)::BIGINT AS taken FROM e
      WHERE served <= (SELECT floor(sum(size)::DOUBLE * 1.5::DOUBLE) FROM d) GROUP BY id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN g USING (id)
"""

ORACLE["op8_embeddings"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a, v b
  WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95::DOUBLE),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT vec_id, coalesce((SELECT count(*) FROM l WHERE l.x = vec_id), 0)::BIGINT AS n_links,
       least(vec_id, coalesce((SELECT min(y) FROM r WHERE r.x = vec_id), vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce((SELECT min(y) FROM r WHERE r.x = vec_id), vec_id)) AS kept
FROM embeddings
"""

ORACLE["op11_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
       + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
       + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
       + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
       + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS bits
  FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (
  SELECT part, bits, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, bits),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(x, m)),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.m, b.m, c.m, d.m, e.m] AS ms
  FROM x a, x b, x c, x d, x e WHERE a.m + b.m + c.m + d.m + e.m = 31 AND len(list_distinct([a.m, b.m, c.m, d.m, e.m])) = 5),
s AS (
  SELECT filter_order, step::INT AS step, ms[step] AS m, coalesce(list_sum(ms[1:step - 1]), 0)::INT AS before
  FROM o, range(1, 6) AS r(step)),
r AS (
  SELECT part, filter_order, step, m,
         coalesce(sum(n) FILTER (bits & (before | m) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (bits & before = 0 AND bits & m <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (bits & before <> 0 AND bits & m <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (bits = m), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (bits & before = 0 AND bits & m <> 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (bits & before = 0 AND bits & m <> 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, m)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, m))::BIGINT AS shapley
FROM r
"""

ORACLE["op12_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (
  SELECT *, len(text) + len(text) - len(replace(text, '\', '')) + (len(text) - len(replace(text, '</turn>', ''))) // 7
            + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: len(x))), 0) AS text_chars,
         len(role) + len(role) - len(replace(role, '\', '')) + (len(role) - len(replace(role, '</turn>', ''))) // 7
            + len(role) - len(replace(role, ':', ''))
            + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{3,}'), lambda x: len(x))), 0) AS role_chars
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + role_chars + 2 + text_chars + 8)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""

ORACLE["op13_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS no, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL),
n AS (SELECT no, doc_id, len(t)::BIGINT AS n, t FROM d WHERE len(t) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM n),
p AS (SELECT no, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT no, doc_id, n, unnest(t) AS term FROM n) GROUP BY no, doc_id, n, term),
w AS (SELECT term, floor(1000 * ln((2 * s.docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, s.docs),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
r AS (
  SELECT item_id, doc_id, no, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * s.docs) // s.total))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY item_id, doc_id, no)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 10
"""
