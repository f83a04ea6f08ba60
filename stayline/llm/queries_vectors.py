"""Queries of the vector operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.llm.registry import query, table
from stayline.llm.topk_search import top_k
from stayline.llm.whitening import whitened


@query(
    "op10_top_k",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
""",
)
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
