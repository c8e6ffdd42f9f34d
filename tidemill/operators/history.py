"""Inspection of history tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.union import union_all


def key_history(
    history: DataFrame, key: str, value: Any, time_column: str = "modified_at"
) -> DataFrame:
    """All versions of one key, oldest first. The comparison is pushed into the scan."""
    return history.where(F.col(key) == value).orderBy(F.col(time_column).asc_nulls_first())


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Row count per table name; a missing table (``None``) has a null count. Plain Parquet counts
    come from file footers."""
    counts = []
    for name, df in tables.items():
        if df is None:
            missing = spark.range(1)
            count = missing.select(F.lit(None).cast("long").alias("row_count"))
        else:
            count = df.agg(F.count(F.lit(1)).alias("row_count"))
        counts.append(count.select(F.lit(name).alias("table_name"), "row_count"))
    return union_all(counts)
