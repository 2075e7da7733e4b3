"""DuckDB SQL of the queries that SQL can express, written from their contracts alone."""

EXACT = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
"""

# one row a conversation and step; a state is {c: cost, a: letters, r: repaired lines}, and structs compare in this order
CONVERSATIONS = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS k
  FROM conversations),
crc AS (
  -- CRC-32, bit by bit: a byte is mixed in, then eight steps (-1) shift and fold
  SELECT *, xor(list_reduce(
      [4294967295::BIGINT] || flatten(list_transform(range(octet_length(k)), lambda i:
          [('0x' || substr(hex(k), 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT) % 20 AS kind
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, LATERAL (SELECT unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS i0, CASE
      WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault
  FROM ranked),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i0 || i NOT IN ('su', 'ua', 'au')) AS illegal,
         max(p) AS n
  FROM faulty GROUP BY conv_id),
steps AS (
  SELECT conv_id, 0::BIGINT AS p, 0 AS phase, {'c': 0::BIGINT, 'a': '', 'r': ''} AS z, {'c': 1000000::BIGINT, 'a': '', 'r': ''} AS s,
         {'c': 1000000::BIGINT, 'a': '', 'r': ''} AS u, {'c': 1000000::BIGINT, 'a': '', 'r': ''} AS a
  FROM counts
  UNION ALL
  -- phases 0 to 2 allow one insertion each, phase 3 takes the next row
  SELECT conv_id, CASE WHEN phase < 3 THEN p ELSE p + 1 END, (phase + 1) % 4,
    CASE WHEN phase < 3 THEN z ELSE del_z END,
    CASE WHEN phase < 3 THEN s WHEN stays AND i = 's' THEN least(del_s, {'c': z.c + x, 'a': z.a || 'K', 'r': z.r || line}) ELSE del_s END,
    CASE WHEN phase < 3 THEN least(u, {'c': z.c + 5, 'a': z.a || 'I', 'r': z.r || chr(10) || 'user:'},
        {'c': s.c + 5, 'a': s.a || 'I', 'r': s.r || chr(10) || 'user:'}, {'c': a.c + 5, 'a': a.a || 'I', 'r': a.r || chr(10) || 'user:'})
      WHEN NOT stays THEN del_u
      ELSE least(del_u, {'c': z.c + ku, 'a': z.a || lu, 'r': z.r || tu}, {'c': s.c + ku, 'a': s.a || lu, 'r': s.r || tu},
        {'c': a.c + ku, 'a': a.a || lu, 'r': a.r || tu}) END,
    CASE WHEN phase < 3 THEN least(a, {'c': u.c + 5, 'a': u.a || 'I', 'r': u.r || chr(10) || 'assistant:'})
      WHEN NOT stays THEN del_a ELSE least(del_a, {'c': u.c + ka, 'a': u.a || la, 'r': u.r || ta}) END
  FROM (
    SELECT t.*, f.i, f.fault IS DISTINCT FROM 'blank' AND f.fault IS DISTINCT FROM 'duplicate' AS stays,
      CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS x, chr(10) || f.role || ':' || f.text AS line,
      CASE WHEN f.i = 'u' THEN x ELSE x + 1 END AS ku, CASE WHEN f.i = 'u' THEN 'K' ELSE 'R' END AS lu,
      CASE WHEN f.i = 'u' THEN line ELSE chr(10) || 'user:' || f.text END AS tu,
      CASE WHEN f.i = 'a' THEN x ELSE x + 1 END AS ka, CASE WHEN f.i = 'a' THEN 'K' ELSE 'R' END AS la,
      CASE WHEN f.i = 'a' THEN line ELSE chr(10) || 'assistant:' || f.text END AS ta,
      {'c': t.z.c + 2, 'a': t.z.a || 'D', 'r': t.z.r} AS del_z, {'c': t.s.c + 2, 'a': t.s.a || 'D', 'r': t.s.r} AS del_s,
      {'c': t.u.c + 2, 'a': t.u.a || 'D', 'r': t.u.r} AS del_u, {'c': t.a.c + 2, 'a': t.a.a || 'D', 'r': t.a.r} AS del_a
    FROM steps t LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.p = t.p + 1
    WHERE t.phase < 3 OR f.p IS NOT NULL)),
best AS (
  SELECT t.conv_id, least(t.z, t.a) AS w FROM steps t JOIN counts k ON k.conv_id IS NOT DISTINCT FROM t.conv_id AND t.p = k.n AND t.phase = 3)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost, coalesce(w.a, '') AS audit,
       sha256(coalesce(substr(w.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
b AS (
  SELECT row_number() OVER () AS r, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM len),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, nn),
scored AS (
  SELECT b.r, b.item_id, tf.r AS d, tf.doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))))::BIGINT AS score
  FROM b JOIN tf USING (term) JOIN w USING (term) JOIN len ON len.r = tf.r, total
  GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

SQL = {"op11_exact_dedup": EXACT, "op12_conversations": CONVERSATIONS, "op13_search": SEARCH}
