from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace, table
from tidemill.llm.language_id import identify, train


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by a network that saw two thirds of the labelled ones at most."""
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", F.coalesce(third == 1, F.lit(False)).alias("held_out")
    )
    network = train(docs.where(third != 1), Workspace(spark))
    judged = identify(docs.select("doc_id", "text", "held_out"), network)
    return judged.select("doc_id", "held_out", "lang_pred", "score")
