"""Queries of the join operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklab.llm import hard_negatives, partenum
from tracklab.llm.common import query, table

# Words by ASCII white space, A-Z in lower case; equal shingle lists are compared once.
_JOIN_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), g AS (
  SELECT rid, CASE WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                   ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' ')) END AS gs
  FROM d WHERE len(ws) > 0
), s AS (
  SELECT rid, list_sort(list_distinct(gs)) AS gs FROM g
), c AS (
  SELECT min(rid) AS cid, gs FROM s GROUP BY gs
), member AS (
  SELECT s.rid, c.cid, len(s.gs) AS n FROM s JOIN c USING (gs)
), e AS (
  SELECT cid, unnest(gs) AS x, len(gs) AS n FROM c
), pair AS (
  SELECT a.cid AS a, b.cid AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM e a JOIN e b ON a.x = b.x AND a.cid < b.cid AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY 1, 2 HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
), link AS (
  SELECT a, b FROM pair UNION SELECT b, a FROM pair
), reach(a, b) AS (
  SELECT cid, cid FROM c UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), root AS (
  SELECT a AS cid, min(doc_id) AS first FROM reach JOIN member ON member.cid = reach.b JOIN d USING (rid) GROUP BY a
)
SELECT d.doc_id, coalesce(member.n, 0)::BIGINT AS n_shingles, coalesce(root.first, d.doc_id) AS component_id
FROM d LEFT JOIN member USING (rid) LEFT JOIN root USING (cid)
"""


@query(_JOIN_SQL)
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of similar documents, three-word shingles at 90 percent, for every document."""
    return partenum.join_components(table(spark, sf_dir, "documents"))


# Scores of anchors against all rows; 64-bit sums of whole numbers are exact as doubles here.
_MINING_SQL = r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS same, b.rid AS other, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS pos
  FROM s WHERE same QUALIFY pos <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.rid, p.pos ORDER BY s.score DESC, s.vec_id, s.other)::INT AS rank
  FROM p JOIN s ON s.rid = p.rid AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query(_MINING_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives just below the positives of every fiftieth vector, with a seventh of the labels moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.scaled(table(spark, sf_dir, "embeddings").withColumn("label", moved))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0).drop("positive_rank")
