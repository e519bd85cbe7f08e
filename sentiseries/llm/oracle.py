"""SQL that the registered queries must equal, where SQL can express them."""

from __future__ import annotations


def _leaf(n_chars: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


#: Levels by recursion, then every leaf folded upwards through its tree and the tree of subroots.
MERKLE = f"""
WITH RECURSIVE
bits AS (
  SELECT n, 0 AS k, n AS c FROM range(256) AS r(n)
  UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR AS s, 1 AS i, 4294967295 AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, s, i + 1, xor(b.c, crc.c >> 8) FROM crc JOIN bits b ON b.k = 8 AND b.n = xor(crc.c, ascii(s[i])) & 255 WHERE i <= length(s)),
forged AS (SELECT doc_id FROM crc WHERE i > length(s) AND xor(c, 4294967295) % 7 = 0),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
    SELECT doc_id, lang, {_leaf("n_chars::VARCHAR")} AS leaf,
      CASE WHEN doc_id IN (FROM forged) THEN {_leaf("(n_chars::HUGEINT + 1)::VARCHAR")} END AS other FROM documents)),
tree AS (
  SELECT lang, 0 AS lev, pos, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL SELECT lang, lev + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, lev + 1, pos // 2),
ends AS (SELECT lang, lev AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM tree WHERE n = 1),
upper_tree AS (
  SELECT 0 AS lev, place AS pos, subroot AS digest, count(*) OVER () AS n FROM ends
  UNION ALL SELECT lev + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM upper_tree WHERE n > 1 GROUP BY lev + 1, pos // 2),
top AS (SELECT lev AS height, digest AS root FROM upper_tree WHERE n = 1),
low AS (
  SELECT lang, pos, 0 AS lev, coalesce(other, leaf) AS node, '' AS sib FROM leaves
  UNION ALL SELECT low.lang, low.pos, low.lev + 1,
    sha256(CASE WHEN (low.pos >> low.lev) & 1 = 1 THEN t.digest || node ELSE node || coalesce(t.digest, '') END), sib || coalesce(t.digest, '')
  FROM low JOIN ends e ON e.lang IS NOT DISTINCT FROM low.lang AND low.lev < e.height
    LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM low.lang AND t.lev = low.lev AND t.pos = xor(low.pos >> low.lev, 1)),
high AS (
  SELECT low.lang, low.pos, e.place, 0 AS lev, node, sib FROM low JOIN ends e ON e.lang IS NOT DISTINCT FROM low.lang AND low.lev = e.height
  UNION ALL SELECT high.lang, high.pos, place, high.lev + 1,
    sha256(CASE WHEN (place >> high.lev) & 1 = 1 THEN t.digest || node ELSE node || coalesce(t.digest, '') END), sib || coalesce(t.digest, '')
  FROM high JOIN top ON high.lev < top.height LEFT JOIN upper_tree t ON t.lev = high.lev AND t.pos = xor(place >> high.lev, 1))
SELECT l.doc_id, l.leaf, e.subroot, top.root, sha256(h.sib) AS proof_sha256, h.node AS folded_root, h.node = top.root AS verified
FROM leaves l JOIN ends e ON e.lang IS NOT DISTINCT FROM l.lang CROSS JOIN top
JOIN high h ON h.lang IS NOT DISTINCT FROM l.lang AND h.pos = l.pos AND h.lev = top.height"""


#: Every distance priced term by term, in whole numbers of any size.
DIVERGENCE = """
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT id, lang, source,
    translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(c, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN langs USING (lang) LEFT JOIN (SELECT lang, source, sum(c) AS c FROM cells GROUP BY lang, source) USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, k.total,
    1 + 1000000000 * (coalesce(c, 0)::HUGEINT + 1) // (g.n + g.v)::HUGEINT AS p
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN cells x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM (
    SELECT s.lang, source, term, c, p, 1 + 1000000000 * (total::HUGEINT + 1) // (l.n + l.v)::HUGEINT AS q FROM shares s JOIN langs l ON l.lang = s.lang)
  WHERE c > 0 AND p > q),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', item, value::BIGINT FROM found)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM parts)
WHERE part = 'pair' OR rank <= 200"""
