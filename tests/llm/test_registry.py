"""The registered queries: SQL where there is some, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from tests.compare import assert_same, duck
from tidemill.llm import registry

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [n for n in registered.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in registered.queries()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    df = registered.queries()[name](spark, SF)
    assert assert_same(df, duck(SF), registry.oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_line_dedup"])
def test_native_plans_have_no_python(spark, name):
    df = registered.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_pipeline_stages(spark, work):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = work.keep(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.columns == columns
        assert docs.count() <= rows
        rows = docs.count()
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert final.count() == rows and final.where("NOT intact").count() == 0


def test_pipeline_on_an_empty_table_and_odd_rows(spark, work, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    spark.read.parquet(f"{SF}/embeddings.parquet").write.parquet(f"{tmp_path}/embeddings.parquet")
    source.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    some = source.limit(30)
    nulls = spark.createDataFrame([(None,) * 5] * 2 + [(1, "", None, None, 0)], source.schema)
    some.union(some).union(nulls).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == found.select("doc_id").distinct().count()
