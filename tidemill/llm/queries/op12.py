from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace, table
from tidemill.llm.phrase_index import build_index, covered, find_passages


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a passage of ten words of a benchmark item."""
    work = Workspace(spark)
    index = build_index(table(spark, sf_dir, "documents"), work)
    found = find_passages(index, table(spark, sf_dir, "benchmark"), work)
    return covered(index, found).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), tests AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), sized AS (
    SELECT item_id, words, least(10, len(words)) AS size FROM tests WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, size, words[i + 1 : i + size] AS gram
    FROM (SELECT *, unnest(range(len(words) - size + 1)) AS i FROM sized)
), sizes AS (
    SELECT DISTINCT size FROM windows
), grams AS (
    SELECT row, i, size, words[i + 1 : i + size] AS gram
    FROM (SELECT row, words, size, unnest(range(len(words) - size + 1)) AS i FROM docs, sizes
          WHERE len(words) >= size)
), matches AS (
    SELECT g.row, g.i, g.size, w.item_id FROM grams g JOIN windows w ON w.size = g.size AND w.gram = g.gram
), hits AS (
    SELECT row, count(*) AS n_hit
    FROM (SELECT DISTINCT row, unnest(range(i, i + size)) AS place FROM matches) GROUP BY row
), named AS (
    SELECT row, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS name FROM matches WHERE item_id IS NOT NULL)
    GROUP BY row
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.row = d.row LEFT JOIN named n ON n.row = d.row
"""
