from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace, table
from tidemill.llm.separator_scan import count_tokens, write_flat_files

# <|endoftext|> of the vocabulary; no text encodes to it.
SEPARATOR = 49407


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, found in flat token files of them.

    The ids come from the order of writing; the counts come from the files alone.
    """
    docs = table(spark, sf_dir, "documents")
    work = Workspace(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    written = write_flat_files(docs, path, SEPARATOR, work)
    files = written.groupBy("path").agg(F.max("bytes").alias("bytes"))
    counts = count_tokens(files, SEPARATOR, "<u2", work)
    return written.join(counts, ["path", "place"], "full").select("doc_id", "n_tokens", "closed")
