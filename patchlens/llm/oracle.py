"""SQL twins, for DuckDB, of the queries that SQL can express."""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(breaks: str) -> str:
    return f"coalesce(list_filter(regexp_split_to_array({_LOWERED}, '{breaks}+'), lambda x: x <> ''), [])"


_ALNUM = _words(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_SPACED = _words(r"[\x20\x09-\x0D]")

DECONTAMINATION = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
item AS (SELECT item_id, {_ALNUM} AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM item WHERE len(w) > 0),
wanted AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
place AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM doc, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n),
met AS (
  SELECT r, i, p.n, item_id
  FROM (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM place) p
  JOIN wanted USING (n, k)),
hit AS (
  SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM met) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

JACCARD = f"""
WITH RECURSIVE doc AS (SELECT row_number() OVER () AS r, doc_id, {_SPACED} AS w FROM documents),
shingle AS (
  SELECT DISTINCT r, array_to_string(w[i : i + 2], ' ') AS k
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
pair AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM shingle a JOIN shingle b USING (k) WHERE a.r <> b.r GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.r = a JOIN size y ON y.r = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
reach AS (SELECT r AS a, r AS b FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM doc LEFT JOIN size USING (r)
JOIN (SELECT reach.a AS r, min(other.doc_id) AS component_id FROM reach JOIN doc other ON other.r = reach.b GROUP BY 1)
  USING (r)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND (a.vec_id <> b.vec_id)),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
