"""DuckDB statements for the queries that SQL can express (independent of the Spark code)."""

from __future__ import annotations

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
-- an escaped character grows by one; the three marks of a turn have 8 characters each
sized AS (SELECT *, length(regexp_replace(role || text, '([\\<\[])', '\1\1', 'g')) + 24 AS shown FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(shown)::BIGINT AS formatted_chars,
       0::BIGINT AS n_attachments, 0::BIGINT AS expanded_tokens -- the table's turns hold text only
FROM sized GROUP BY conv_id
"""

SHARDS = """
WITH RECURSIVE shards AS (
  SELECT i AS shard, ('0x' || substr(md5('shard-' || i || '/offset'), 1, 15))::BIGINT % 4099 AS off,
         ('0x' || substr(md5('shard-' || i || '/stride'), 1, 15))::BIGINT % 4098 + 1 AS stride
  FROM range(32) r(i)),
fill(step, slot, free) AS (
  SELECT -1, -1::BIGINT, [true for x in range(4099)]
  UNION ALL
  SELECT step + 1, pick, list_transform(range(4099), lambda i: free[i + 1] AND i <> pick)
  FROM (SELECT step, free, list_filter(list_transform(range(4099), lambda j: (off + j * stride) % 4099),
                                       lambda s: free[s + 1])[1] AS pick
        FROM fill JOIN shards ON shards.shard = (fill.step + 1) % 32 WHERE step < 4098)),
place AS (SELECT slot, (step % 32)::INTEGER AS shard FROM fill WHERE step >= 0)
SELECT doc_id, d.slot, shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, ''))), 1, 15))::BIGINT
             % 4099 AS slot FROM documents) d JOIN place ON place.slot = d.slot
"""

#: Words and 5-word shingles of every text, distinct per document, and the links' components.
JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s
  FROM w),
sh AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY x, y HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(reach.y) AS component_id
FROM sets JOIN reach ON reach.x = sets.doc_id GROUP BY sets.doc_id, s
"""

_QUALITY_CTE = r"""
qw AS (SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
grams AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM qw),
windows AS (SELECT doc_id, i, ws[i:i + 2] AS g FROM grams),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM qw),
dups AS (SELECT doc_id, sum(k - 1) AS n FROM (SELECT doc_id, line, count(*) AS k FROM lines
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
base AS (
  SELECT qw.doc_id, source, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM qw LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM failed
          WHERE source IS NOT NULL GROUP BY source),
moments AS (SELECT sum(n) AS n, sum(f) / sum(n) AS m, count(*) AS k, sum(n * n) AS n2, sum(f * f / n) AS f2 FROM hosts),
spread AS (SELECT m, k, m * (1 - m) AS noise,
    (f2 - n * m * m - (k - 1) * m * (1 - m)) / greatest(n - n2 / n, 1e-9) AS tau2 FROM moments),
prior AS (SELECT m, CASE WHEN k < 2 OR tau2 <= noise * 1e-6 THEN 1e6 ELSE greatest(noise / tau2 - 1, 1e-6) END AS strength FROM spread),
verdict AS (SELECT source, (f + m * strength) / (n + strength) <= 0.5 AS ok FROM hosts, prior)
"""

QUALITY = "WITH " + _QUALITY_CTE + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(ok, true) AS kept
FROM failed LEFT JOIN verdict USING (source)
"""

#: Trees of 16 by source, a tree over the subroots, and every row's way up, one level a step.
MERKLE = r"""
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '-') AS tree,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
hashed AS (
  SELECT r, doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS low_leaf FROM fields),
-- crc32 of the decimal id, bit by bit
codes(r, left_over, crc) AS (
  SELECT r, doc_id::VARCHAR, 4294967295::UBIGINT FROM fields WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT r, left_over[2:], list_reduce(list_prepend(xor(crc, ord(left_over[1])::UBIGINT), range(8)::UBIGINT[]),
           lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)
  FROM codes WHERE left_over <> ''),
chosen AS (SELECT r FROM codes WHERE left_over = '' AND xor(crc, 4294967295::UBIGINT) % 5 = 0),
leaves AS MATERIALIZED (
  SELECT h.*, CASE WHEN chosen.r IS NULL THEN leaf ELSE low_leaf END AS shown,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed h LEFT JOIN chosen USING (r)),
inner_levels AS (
  SELECT tree, 0 AS level, i, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (any_value(n) + 15) // 16
  FROM inner_levels WHERE n > 1 GROUP BY tree, i // 16),
subroots AS MATERIALIZED (
  SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM inner_levels WHERE n = 1),
top_levels AS (
  SELECT '' AS tree, 0 AS level, i, digest, n FROM subroots
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (any_value(n) + 15) // 16
  FROM top_levels WHERE n > 1 GROUP BY tree, i // 16),
runs AS MATERIALIZED (
  SELECT tree, level, i // 16 AS up, list(digest ORDER BY i) AS kids, any_value(n) AS n
  FROM (SELECT * FROM inner_levels UNION ALL SELECT * FROM top_levels) WHERE n > 1 GROUP BY tree, level, i // 16),
ways AS (
  SELECT r, tree, 0 AS level, i, n, shown AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT w.r, w.tree, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END, CASE WHEN w.n > 1 THEN w.i // 16 ELSE s.i END,
    CASE WHEN w.n > 1 THEN (w.n + 15) // 16 ELSE s.n END,
    CASE WHEN w.n > 1 THEN sha256(array_to_string(list_concat(kids[1:w.i % 16], [w.h], kids[w.i % 16 + 2:]), '')) ELSE w.h END,
    CASE WHEN w.n > 1 THEN w.proof || array_to_string(list_concat(kids[1:w.i % 16], kids[w.i % 16 + 2:]), '') ELSE w.proof END
  FROM (SELECT r, CASE WHEN n = 1 THEN '' ELSE tree END AS tree, tree AS own, level, i, n, h, proof FROM ways
        WHERE n > 1 OR tree <> '') w
  LEFT JOIN runs ON runs.tree = w.tree AND runs.level = w.level AND runs.up = w.i // 16 AND w.n > 1
  LEFT JOIN subroots s ON s.tree = w.own AND w.n = 1)
SELECT doc_id, leaf, subroots.digest AS subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM leaves JOIN ways ON ways.r = leaves.r AND ways.tree = '' AND ways.n = 1 JOIN subroots ON subroots.tree = leaves.tree,
  (SELECT digest AS root FROM top_levels WHERE n = 1)
"""

ORACLE_SQL: dict[str, str] = {"op3_sharding": SHARDS, "op4_chat_format": CHAT,
                              "op8_jaccard_join": JACCARD, "op9_host_quality": QUALITY,
                              "op13_merkle_manifest": MERKLE}
