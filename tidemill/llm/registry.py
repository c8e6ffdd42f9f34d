"""The queries of the training-data operators and the SQL some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemill.llm.common import importable
from tidemill.llm.queries import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13

Query = Callable[[SparkSession, str], DataFrame]

MODULES = {
    "op1_quality_rules": op1,
    "op2_line_dedup": op2,
    "op3_byte_bpe": op3,
    "op4_token_files": op4,
    "op5_ngram_jaccard": op5,
    "op6_top_k_search": op6,
    "op7_mixing": op7,
    "op8_url_filter": op8,
    "op9_token_counts": op9,
    "op10_language_id": op10,
    "op11_centroid_clustering": op11,
    "op12_decontamination": op12,
    "op13_periodic_runs": op13,
}


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    own = {name: _ready(module.query) for name, module in MODULES.items()}
    return {**own, "pipeline": _ready(corpus_pipeline.run)}


def oracle_sql() -> dict[str, str]:
    own = {name: module.SQL for name, module in MODULES.items() if hasattr(module, "SQL")}
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
