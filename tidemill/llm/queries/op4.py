from __future__ import annotations

import zlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.common import Workspace, table
from tidemill.llm.token_files import files_in_order, read_batches, write_token_files


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files, then report what the files hold of each."""
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_token_files(docs, path, Workspace(spark))

    def run(batches):
        for batch in read_batches(batches):
            ids = (x.values.to_numpy().astype("<u4") for x in batch.column("ids"))
            sums = pa.array(map(zlib.crc32, ids), pa.int64())
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*columns, sums], names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return files_in_order(manifest).mapInArrow(run, schema)
