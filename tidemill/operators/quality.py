"""Declared data tests as violation counts. Zero violations is a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.contracts import Checks
from tidemill.operators.union import union_all


def not_null(df: DataFrame, relation: str, columns: Iterable[str]) -> DataFrame:
    """Null counts of all ``columns`` in one pass over ``df``, one result row per column."""
    columns = list(columns)
    counts = df.selectExpr(*(f"count_if(`{c}` IS NULL) AS `{c}`" for c in columns))
    rows = ", ".join(f"struct('{c}' AS column, `{c}` AS violations)" for c in columns)
    return counts.selectExpr(
        "'not_null' AS check_name", f"'{relation}' AS relation", f"inline(array({rows}))"
    )


def unique(df: DataFrame, relation: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once. Counts are combined before the shuffle,
    so a value with very many copies arrives as one row per task."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    return _result("unique", relation, column, repeated, "count(1)")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null values of ``column`` without a parent, with the number of child rows of each.

    Child rows are counted per value first: what meets the parent is one row per value, never the
    rows of a hot value.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(parent_column))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    missing = counted.join(parent.select(parent_column), parent_column, "left_anti")
    return missing.select(F.col(parent_column).alias(column), "rows")


def relationships(
    child: DataFrame, relation: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Number of child rows whose non-null ``column`` has no parent."""
    missing = orphans(child, column, parent, parent_column)
    return _result("relationships", relation, column, missing, "coalesce(sum(rows), 0L)")


def _result(
    check: str, relation: str, column: str, violations: DataFrame, total: str
) -> DataFrame:
    return violations.selectExpr(
        f"'{check}' AS check_name",
        f"'{relation}' AS relation",
        f"'{column}' AS column",
        f"{total} AS violations",
    )


def run_checks(relations: Mapping[str, DataFrame], checks: Mapping[str, Checks]) -> DataFrame:
    """One row per declared check of the given relations: check_name, relation, column, violations.

    Each relation is read once per uniqueness or relationship check and once for all null checks;
    pass written tables, not views, where a relation is expensive to derive.
    """
    results = []
    for name, declared in checks.items():
        if name not in relations:
            continue
        df = relations[name]
        if declared.not_null:
            results.append(not_null(df, name, declared.not_null))
        results += [unique(df, name, column) for column in declared.unique]
        results += [
            relationships(df, name, column, relations[parent], parent_column)
            for column, parent, parent_column in declared.relationships
        ]
    return union_all(results)


def violated(report: DataFrame) -> DataFrame:
    """The checks that fail."""
    return report.where(F.col("violations") > 0)
