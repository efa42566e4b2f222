"""DuckDB SQL of the text queries that SQL can express, over whole tables."""

ORACLE: dict[str, str] = {}

ORACLE["op11_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase FROM places, (VALUES (1), (2), (3)) AS s(size) WHERE i + size - 1 <= len(w)
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), found AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, p.f AS l, q.f AS r, ((1000000::HUGEINT * c.a * c.a) // (p.f::HUGEINT * q.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM found) AS c
  JOIN counts AS p ON p.lang = c.lang AND p.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN counts AS q ON q.lang = c.lang AND q.phrase = array_to_string(c.w[k + 1 : c.size], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS longer FROM found, (VALUES (1), (2)) AS s(i) WHERE size = 3 GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best AS b LEFT JOIN inside AS o ON o.lang = b.lang AND o.phrase = b.phrase WHERE coalesce(100 * longer < 50 * a, true)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE["op13_conversations"] = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i::BIGINT AS v FROM range(256) AS b(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
), given AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations
), drawn AS (
  SELECT g.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 20 AS f
  FROM given AS g, crc
), hurt AS (
  SELECT conv, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM drawn JOIN (VALUES (1), (2)) AS c(copy) ON copy = 1 OR f = 3 WHERE f <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos FROM hurt
), seen AS (
  SELECT *, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final, row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) AS nth,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS r
  FROM numbered
), marked AS (
  SELECT *, CASE WHEN final = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    lag(r) OVER (PARTITION BY conv ORDER BY pos) || r AS pair, count(*) OVER (PARTITION BY conv) AS n
  FROM seen
), totals AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv
), costs AS (
  SELECT DISTINCT conv, n + 1 AS pos, {'c': 0, 'a': ''} AS s0, {'c': 6, 'a': 'II'} AS s1, {'c': 3, 'a': 'I'} AS s2, {'c': 0, 'a': ''} AS s3 FROM marked
  UNION ALL
  SELECT conv, pos, list_min([p0, {'c': 3 + m2.c, 'a': 'I' || m2.a}]), list_min([p1, {'c': 3 + m2.c, 'a': 'I' || m2.a}]), m2, list_min([p3, {'c': 3 + p2.c, 'a': 'I' || p2.a}])
  FROM (
    SELECT *, list_min([p2, {'c': 3 + p3.c, 'a': 'I' || p3.a}]) AS m2 FROM (
      SELECT c.conv, m.pos,
        list_min(list_filter([{'c': 4 + s0.c, 'a': 'D' || s0.a}, CASE WHEN must THEN NULL WHEN r = 's' THEN {'c': t + s1.c, 'a': 'K' || s1.a} WHEN r = 'u' THEN {'c': t + s2.c, 'a': 'K' || s2.a} END,
          CASE WHEN NOT must THEN {'c': 3 + t + s2.c, 'a': 'R' || s2.a} END], lambda x: x IS NOT NULL)) AS p0,
        list_min(list_filter([{'c': 4 + s1.c, 'a': 'D' || s1.a}, CASE WHEN NOT must AND r = 'u' THEN {'c': t + s2.c, 'a': 'K' || s2.a} END,
          CASE WHEN NOT must THEN {'c': 3 + t + s2.c, 'a': 'R' || s2.a} END], lambda x: x IS NOT NULL)) AS p1,
        list_min(list_filter([{'c': 4 + s2.c, 'a': 'D' || s2.a}, CASE WHEN NOT must AND r = 'a' THEN {'c': t + s3.c, 'a': 'K' || s3.a} END,
          CASE WHEN NOT must THEN {'c': 3 + t + s3.c, 'a': 'R' || s3.a} END], lambda x: x IS NOT NULL)) AS p2,
        list_min(list_filter([{'c': 4 + s3.c, 'a': 'D' || s3.a}, CASE WHEN NOT must AND r = 'u' THEN {'c': t + s2.c, 'a': 'K' || s2.a} END,
          CASE WHEN NOT must THEN {'c': 3 + t + s2.c, 'a': 'R' || s2.a} END], lambda x: x IS NOT NULL)) AS p3
      FROM costs AS c JOIN (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS t FROM marked) AS m ON m.conv = c.conv AND m.pos = c.pos - 1
    )
  )
), best AS (
  SELECT conv, s0.c::BIGINT AS cost, s0.a AS audit FROM costs WHERE pos = 1
), walk AS (
  SELECT conv, audit, 0 AS k, 0::BIGINT AS pos, '0' AS state, '' AS edit, NULL::VARCHAR AS line FROM best
  UNION ALL
  SELECT conv, audit, k + 1, CASE WHEN e = 'I' THEN pos ELSE pos + 1 END, CASE e WHEN 'D' THEN state WHEN 'K' THEN r ELSE need END, e,
    CASE e WHEN 'K' THEN role || ':' || text WHEN 'R' THEN CASE need WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text WHEN 'I' THEN CASE need WHEN 'u' THEN 'user:' ELSE 'assistant:' END END
  FROM (
    SELECT w.conv, w.audit, w.k, w.pos, w.state, audit[k + 1] AS e, CASE WHEN state = 'u' THEN 'a' ELSE 'u' END AS need, m.r, m.role, m.text
    FROM walk AS w LEFT JOIN marked AS m ON m.conv = w.conv AND m.pos = w.pos + 1 WHERE k < length(audit)
  )
), hashes AS (
  SELECT conv, sha256(coalesce(string_agg(line, chr(10) ORDER BY k), '')) AS sha FROM walk GROUP BY conv
)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM given) AS g LEFT JOIN totals USING (conv) LEFT JOIN best USING (conv) LEFT JOIN hashes USING (conv)
"""

ORACLE["op2_top_k"] = r"""
WITH whole AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM whole AS q JOIN whole AS c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
