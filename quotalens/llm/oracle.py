"""DuckDB SQL of the operators that SQL can express, derived from their definitions."""

from __future__ import annotations

#: Phrases as texts of each start and length, all counts by grouping them.
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT lang, piece, row_number() OVER () AS id FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
words AS (
  SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM (
    SELECT lang, id, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
    FROM pieces)),
ahead AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4,
         lead(w1, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY id ORDER BY i)),
grams AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM ahead
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM ahead WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3) FROM ahead WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4) FROM ahead WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, concat_ws(' ', w1, w2, w3, w4, w5) FROM ahead WHERE w5 IS NOT NULL),
counts AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND a >= 100),
cuts AS (
  SELECT c.lang, c.phrase, c.a, f.a AS l, g.a AS r, t.n, j.j AS j,
         ((1000::HUGEINT * c.a * t.n) // (f.a::HUGEINT * g.a))::BIGINT AS score
  FROM candidates c JOIN (SELECT unnest(range(1, 5)) AS j) AS j ON j.j < c.k
  JOIN counts f ON f.lang = c.lang AND f.k = j.j AND f.phrase = array_to_string(c.w[1:j.j], ' ')
  JOIN counts g ON g.lang = c.lang AND g.k = c.k - j.j AND g.phrase = array_to_string(c.w[j.j + 1:c.k], ' ')
  JOIN totals t ON t.lang = c.lang),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates o
    WHERE o.lang = s.lang AND o.k > len(string_split(s.phrase, ' ')) AND 100 * o.a >= 100 * s.a
      AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n::BIGINT AS n, score
FROM kept
QUALIFY rank <= 2000
"""

#: Prefix sums by a window over all rows; the checksum by folding bytes into 32 bits, bit by bit.
SHARDS = r"""
WITH RECURSIVE table0 AS (SELECT b, b::BIGINT AS c, 0 AS step FROM (SELECT unnest(range(0, 256)) AS b)),
bits AS (
  SELECT * FROM table0
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
  FROM bits WHERE step < 8),
lookup AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE step = 8),
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, lookup),
placed AS (
  SELECT *, sum(size) OVER w - size AS start, sum(size) OVER () AS total
  FROM sized
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT *, ((2 * start + size) * 8) // (2 * total) AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       NULL::INTEGER AS grown_shard
FROM cut
"""
