"""DuckDB SQL that must give the rows of the queries of this subpackage, where SQL can say it."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('10:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS w
  FROM sized GROUP BY source
),
by_ratio AS (
  SELECT *, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST) AS k FROM sources
),
levels AS (
  SELECT k, w, source_size,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM by_ratio
),
level AS (SELECT arg_min(rate, k) AS rate FROM levels WHERE rate * w <= 2.0::DOUBLE * source_size),
targets AS (
  SELECT source, source_size, CASE WHEN rate IS NULL THEN 2.0::DOUBLE * source_size ELSE least(rate * w, 2.0::DOUBLE * source_size) END AS target
  FROM sources, level
),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
)
SELECT s.doc_id, s.size, p.source_size, p.target,
  CAST(s.size * (p.whole + CASE WHEN sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    <= p.target - p.whole * p.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
"""

DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
item_starts AS (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS i FROM item_words WHERE len(words) > 0),
strings AS (
  SELECT array_to_string(words[i:i + 9], ' ') AS string, least(len(words), 10) AS n, list(DISTINCT item_id) AS items
  FROM item_starts GROUP BY ALL
),
lengths AS (SELECT DISTINCT n FROM strings),
starts AS (
  SELECT r, n, unnest(range(1, len(words) - n + 2)) AS i, words FROM doc_words, lengths WHERE len(words) >= n
),
hits AS (
  SELECT r, i, s.n, s.items FROM starts d JOIN strings s ON s.n = d.n AND s.string = array_to_string(d.words[i:i + d.n - 1], ' ')
),
positions AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (
  SELECT r, list(DISTINCT CAST(item AS VARCHAR) ORDER BY CAST(item AS VARCHAR)) AS items
  FROM (SELECT r, unnest(items) AS item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(f.items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(f.items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN positions USING (r) LEFT JOIN found f USING (r)
"""

EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
),
walk(vec_id, reached) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT w.vec_id, l.b FROM walk w JOIN links l ON l.a = w.reached),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT w.vec_id, CAST(coalesce(any_value(c.n), 0) AS BIGINT) AS n_links, min(w.reached) AS component_id, min(w.reached) = w.vec_id AS kept
FROM walk w LEFT JOIN counts c ON c.a = w.vec_id GROUP BY w.vec_id
"""

ORACLES = {"op4_embedding_near_dedup": EMBEDDING_NEAR_DEDUP, "op3_decontamination": DECONTAMINATION, "op10_mixing": MIXING}
