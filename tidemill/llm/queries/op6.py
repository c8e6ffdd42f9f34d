from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table
from tidemill.llm.top_k import top_k_search


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 100, searched in all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    found = top_k_search(vectors, F.col("vec_id") % 100 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """
WITH terms AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.t, c.t), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM terms q JOIN terms c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
    FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS "rank", vec_id, score FROM ranked WHERE place <= 10
"""
