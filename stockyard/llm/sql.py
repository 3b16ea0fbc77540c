"""What the registered queries of this subpackage return, as SQL for DuckDB."""

EXACT_DEDUP = """
WITH plain AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), hashed AS (SELECT doc_id, sha256(norm) AS text_sha256 FROM plain),
grouped AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256
)
SELECT h.doc_id, g.keep_id, g.group_size, h.doc_id = g.keep_id AS kept, h.text_sha256
FROM hashed h JOIN grouped g USING (text_sha256)
"""

URL_FILTER = r"""
WITH rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN
      regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*', 0) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN contains(rest, '/') THEN substr(rest, instr(rest, '/')) ELSE '' END AS path
  FROM parts
), fitting AS (
  SELECT s.page_id, s.host, s.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host) DESC NULLS LAST, length(r.path) DESC) AS place
  FROM split s LEFT JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE place = 1
"""

_CRC_EVEN = """list_reduce(list_concat([4294967295], flatten(list_transform(string_split({0}::VARCHAR, ''),
    lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1]))), lambda crc, x:
    CASE WHEN xor(crc, greatest(x, 0)) & 1 = 1 THEN xor(xor(crc, greatest(x, 0)) >> 1, 3988292384)
         ELSE xor(crc, greatest(x, 0)) >> 1 END) & 1 = 1"""


def _leaf(text: str) -> str:
    told = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(told)})"


MERKLE = f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id) AS doc, doc_id, coalesce('+' || source, '') AS tree,
    {_leaf("text")} AS leaf, CASE WHEN {_CRC_EVEN.format("doc_id")} THEN {_leaf("replace(text, chr(10), '')")} ELSE leaf END AS found
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM docs
), nodes(tree, lv, i, n, h) AS (
  SELECT tree, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT tree, lv + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, lv, i // 3, n
), roots AS MATERIALIZED (
  SELECT tree, lv, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), top(tree, lv, i, n, h) AS (
  SELECT '=', 0, i, n, h FROM roots
  UNION ALL
  SELECT tree, lv + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY tree, lv, i // 3, n
), every AS MATERIALIZED (SELECT * FROM nodes UNION ALL SELECT * FROM top),
steps AS MATERIALIZED (
  SELECT a.tree, a.lv, a.i, a.tree AS to_tree, a.lv + 1 AS to_lv, a.i // 3 AS to_i, false AS hop,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM every a JOIN every b ON a.tree = b.tree AND a.lv = b.lv AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.tree, a.lv, a.i
  UNION ALL
  SELECT tree, lv, 0, '=', 0, i, true, '', '' FROM roots
), way(doc, tree, lv, i, n, proof, h) AS (
  SELECT doc, tree, 0, i, 0, '', found FROM leaves
  UNION ALL
  SELECT w.doc, s.to_tree, s.to_lv, s.to_i, w.n + 1, w.proof || s.l || s.r, CASE WHEN hop THEN w.h ELSE sha256(s.l || w.h || s.r) END
  FROM way w JOIN steps s ON w.tree = s.tree AND w.lv = s.lv AND w.i = s.i
), ended AS (SELECT doc, max_by(proof, n) AS proof, max_by(h, n) AS folded_root FROM way GROUP BY doc)
SELECT d.doc_id, d.leaf, r.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = t.h AS verified
FROM docs d JOIN ended e USING (doc) JOIN roots r ON r.tree = d.tree CROSS JOIN (SELECT h FROM top WHERE n = 1) t
"""

FILTER_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), told AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
    CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails
  FROM texts LEFT JOIN told USING (doc_id)
), counts AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM judged GROUP BY part, fails),
letters(c, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits, a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, s.step::INTEGER AS step, bits[s.step] AS bit, coalesce(list_sum(bits[1:s.step - 1]), 0)::INTEGER AS before
  FROM orders, range(1, 6) s(step)
), rows AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails & before > 0 AND fails & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM counts CROSS JOIN steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM rows
"""
