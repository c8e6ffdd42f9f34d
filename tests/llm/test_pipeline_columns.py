"""Documents with columns named like working columns keep them through every stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
CLASHING = ["topic", "_hash", "_words", "_lines", "kept", "votes", "_id", "_n", "n_deleted", "sampled", "tokens", "doc"]


@pytest.fixture(scope="module")
def plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.union(docs.limit(3))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_clashing_columns_stay(spark, plain, name, stage):
    want = stage(spark, plain, SF)
    if name != "byte-level BPE":
        own = (F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING)
        want = want.select("*", *own)
    want = want.toPandas().astype(str)
    docs = plain.select("*", *(F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING))
    found = stage(spark, docs, SF).toPandas().astype(str)
    assert list(found.columns) == list(want.columns)
    assert sorted(found.values.tolist()) == sorted(want.values.tolist()) and len(found)
