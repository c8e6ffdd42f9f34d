from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.common import Workspace, table
from tidemill.llm.quality import judge, with_votes


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: their measures, the base rule, and the label model's verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged, _ = judge(with_votes(docs).drop("text"), Workspace(spark))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *(f"measures.{m}" for m in measures), "base_failed", "kept", "posterior"
    )
