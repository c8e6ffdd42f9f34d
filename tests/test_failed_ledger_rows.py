"""A file's message takes its ten smallest ids, however many events the file has."""

from pyspark.sql import functions as F

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"


def test_only_ten_ids_of_a_file_are_collected(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    one = events.limit(1).drop("event_id").crossJoin(F.broadcast(spark.range(300).toDF("event_id")))
    one = one.withColumn("event_id", F.when(F.col("event_id") > 0, F.col("event_id")))
    one.select(*events.columns).write.parquet(f"{tmp_path}/events.parquet")
    rows = registered.q_failed_ledger_rows(spark, str(tmp_path))
    (row,) = rows.collect()
    assert row.error_message == ",".join(str(n) * 400 for n in range(1, 12))[:4000]
    assert "WindowGroupLimit" in rows._jdf.queryExecution().optimizedPlan().toString()
