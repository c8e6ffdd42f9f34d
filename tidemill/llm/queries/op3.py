from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import byte_bpe
from tidemill.llm.common import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode in one pass over the texts; only digests leave the tasks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = byte_bpe.Vocabulary(spark, path, public_tokenizers.PATTERN)

    def run(batches):
        encoded = byte_bpe.encode_batches(batches, vocabulary, "text", "ids")
        for batch in byte_bpe.decode_batches(encoded, vocabulary, "ids", "decoded"):
            ids = [x.values.to_numpy().astype("<u4") for x in batch.column("ids")]
            texts = (x.as_buffer() for x in batch.column("decoded"))
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(map(len, ids), pa.int64()),
                "ids_sha256": pa.array(hashlib.sha256(x).hexdigest() for x in ids),
                "decoded_sha256": pa.array(hashlib.sha256(x).hexdigest() for x in texts),
            }
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.mapInArrow(run, schema)
