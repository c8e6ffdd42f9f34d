from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.centroid_clustering import cluster_vectors
from tidemill.llm.common import Workspace, table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components around 16 centroids, after three rounds."""
    found = cluster_vectors(table(spark, sf_dir, "embeddings"), Workspace(spark))
    sums = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    whole = sum(row.inertia for row in sums)
    digests = [
        hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()
    ]
    # A row for each centroid: collecting and broadcasting them is bounded.
    rows = [(row.cluster, row.inertia, whole, digests[row.cluster]) for row in sums]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = spark.createDataFrame(rows, names)
    return found.assigned.join(F.broadcast(centroids), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


ROUNDS = 3

_ROUND = """, d{n} AS (
    SELECT v.row, c.cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
    FROM parts v JOIN c{n} c ON c.d = v.d GROUP BY v.row, c.cluster
), a{n} AS (
    SELECT row, arg_min({{'cluster': cluster, 'distance': distance}}, (distance, cluster)) AS best
    FROM d{n} GROUP BY row
)"""

_MOVE = """, m{n} AS (
    SELECT best.cluster AS cluster, v.d, CAST(floor(sum(v.x) / count(*)) AS BIGINT) AS x
    FROM a{n} a JOIN parts v ON v.row = a.row GROUP BY best.cluster, v.d
), c{next} AS (
    SELECT c.cluster, c.d, coalesce(m.x, c.x) AS x
    FROM c{n} c LEFT JOIN m{n} m ON m.cluster = c.cluster AND m.d = c.d
)"""

SQL = (
    """
WITH kept AS (
    SELECT vec_id, row_number() OVER () AS row,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT row, unnest(range(64)) AS d, unnest(t) AS x FROM kept
), first AS (
    SELECT row, row_number() OVER (ORDER BY sha256('1:' || vec_id), t) - 1 AS cluster
    FROM kept QUALIFY cluster < 16
), c0 AS (
    SELECT f.cluster, p.d, p.x FROM first f JOIN parts p ON p.row = f.row
)"""
    + "".join(
        _ROUND.format(n=n) + (_MOVE.format(n=n, next=n + 1) if n < ROUNDS else "")
        for n in range(ROUNDS + 1)
    )
    + """, digests AS (
    SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256
    FROM c3 GROUP BY cluster
)
SELECT k.vec_id, CAST(best.cluster AS INTEGER) AS cluster, best.distance AS distance,
       CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, g.centroid_sha256
FROM a3 a JOIN kept k ON k.row = a.row JOIN digests g ON g.cluster = best.cluster
"""
)
