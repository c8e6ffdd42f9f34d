from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.common import Workspace, table
from tidemill.llm.line_dedup import dedup_lines


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later copies of line runs of 50 words or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, Workspace(spark)).select("doc_id", "n_lines", "n_deleted", "text")


SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           CAST(unnest(range(len(string_split(text, chr(10))))) AS INTEGER) AS pos
    FROM documents WHERE text IS NOT NULL
), counted AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines
), summed AS (
    SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM counted
), runs AS (
    SELECT s.doc_id, s.pos AS first, min(e.pos) AS last
    FROM summed s JOIN summed e
      ON s.doc_id = e.doc_id AND e.pos >= s.pos AND e.upto - s.upto + s.words >= 50
    GROUP BY s.doc_id, s.pos
    UNION
    SELECT e.doc_id, max(s.pos) AS first, e.pos AS last
    FROM summed s JOIN summed e
      ON s.doc_id = e.doc_id AND e.pos >= s.pos AND e.upto - s.upto + s.words >= 50
    GROUP BY e.doc_id, e.pos
), texts AS (
    SELECT r.doc_id, r.first, r.last, list(l.line ORDER BY l.pos) AS run
    FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND l.pos BETWEEN r.first AND r.last
    GROUP BY r.doc_id, r.first, r.last
), origins AS (
    SELECT *, first_value(doc_id) OVER w AS origin_doc, first_value(first) OVER w AS origin_first
    FROM texts WINDOW w AS (PARTITION BY run ORDER BY doc_id, first)
), deleted AS (
    SELECT DISTINCT o.doc_id, l.pos
    FROM origins o JOIN lines l ON l.doc_id = o.doc_id AND l.pos BETWEEN o.first AND o.last
    WHERE o.doc_id <> o.origin_doc OR o.first > o.origin_first + (o.last - o.first)
), kept AS (
    SELECT l.doc_id, count(*) AS n_lines, count(d.pos) AS n_deleted,
           string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE d.pos IS NULL) AS text
    FROM lines l LEFT JOIN deleted d ON d.doc_id = l.doc_id AND d.pos = l.pos
    GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_deleted, 0) AS n_deleted,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
