from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace, table
from tidemill.llm.ngram_jaccard import similar_components


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose sets of 3-word shingles are similar by 0.9 or more."""
    docs = table(spark, sf_dir, "documents")
    found = similar_components(docs, Workspace(spark), words=3, percent=90)
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")
