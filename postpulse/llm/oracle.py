"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# Fixed values, as in url_rules: base rules, and the globs as patterns.
_URLS = r"""
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.verdict, CASE
         WHEN regexp_matches(host, 'cheap-pills|free-bets|adult-x|spam-farm|ads-track|casino') AND path <> ''
           THEN 'block'
         WHEN regexp_matches(path, '^/(login|cart)(/|$)') THEN 'block'
         WHEN regexp_matches(host || path, '[.](zip|exe)$') THEN 'block'
         ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)
"""

_CHAT = r"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM given
), sized AS (
  SELECT *,
    length(text) + len(regexp_extract_all(text, '\\|<\||</?s>|<</?SYS>>|\[/?INST\]')) + CASE role
      WHEN 'system' THEN 19 WHEN 'user' THEN 15 WHEN 'assistant' THEN 6
      ELSE 23 + length(role) + len(regexp_extract_all(role, '\\|<\||</?s>|<</?SYS>>|\[/?INST\]')) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(chars))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_REPEATS = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)
), first AS (
  SELECT body, min(doc_id) AS d FROM windows GROUP BY body
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j
  FROM windows JOIN first USING (body) WHERE d < doc_id
), kept AS (
  SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.j) FILTER (g.j IS NULL) AS body, count(g.j) AS n_removed
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words) t
  LEFT JOIN gone g USING (doc_id, j) GROUP BY t.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

_NEGATIVES = r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), usual AS (
  SELECT x[:0] AS none, len(x) AS d FROM v GROUP BY ALL ORDER BY count(*) DESC, d LIMIT 1
), u AS (
  SELECT vec_id, label, x FROM v WHERE len(x) = (SELECT d FROM usual)
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.x, b.x), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM u a, u b WHERE a.vec_id % 100 = 0
), near AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored
  WHERE same AND other_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT n.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY n.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
FROM near n JOIN scored s ON n.anchor_id = s.anchor_id AND NOT s.same
  AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

ORACLE = {"op2_chat_format": _CHAT, "op4_substring_dedup": _REPEATS, "op6_url_filter": _URLS, "op12_hard_negatives": _NEGATIVES}
