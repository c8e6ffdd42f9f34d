"""Current state out of an append-only history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.contracts import VERSION_ORDER, Entity
from tidemill.functions import cleaned


def latest_per_key(
    history: DataFrame, keys: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """The newest row per key: greatest ``newest_first`` columns, nulls last.

    Spark plans ``row_number() = 1`` as a group limit before and after the shuffle, so each task
    sends at most one row per key, however many versions one hot key has.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    window = Window.partitionBy(*keys).orderBy(*order)
    return history.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def total_order(history: DataFrame, keys: Sequence[str], leading: Sequence[str]) -> list[str]:
    """``leading`` followed by every other column, so that equal versions leave no choice."""
    return [*leading, *(c for c in history.columns if c not in leading and c not in keys)]


def current_state(history: DataFrame, entity: Entity) -> DataFrame:
    """Latest cleaned version of every business key, with lineage but without the file name."""
    return cleaned_state(latest_versions(history, entity), entity)


def latest_versions(history: DataFrame, entity: Entity) -> DataFrame:
    """Latest version of every business key, as it is in ``history``. What is latest does not depend
    on how history is cut: the latest of several parts' latest versions is the latest of them all."""
    order = total_order(history, [entity.key], VERSION_ORDER)
    return latest_per_key(history, [entity.key], order)


def cleaned_state(latest: DataFrame, entity: Entity) -> DataFrame:
    """Latest versions with cleaned columns, without the file name."""
    return latest.select(
        *(cleaned(c, entity.clean.get(c)) for c in latest.columns if c != "_source_file")
    )


def newer_than(history: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows of ``history`` strictly newer than the newest row of ``target``.

    The watermark is a scalar subquery, so it is found in the same job and the comparison reaches
    the Parquet scan as a pushed filter. Rows without a time never pass.

    Filtering the *history* before ``latest_per_key`` gives the same rows as filtering the current
    state afterwards, as long as ``column`` leads the version order: a key's newest version passes
    exactly if any of its versions does. Doing it first skips row groups of older loads.
    """
    return history.where(F.col(column) > watermark(target, target_column).scalar())


def watermark(target: DataFrame, column: str) -> DataFrame:
    """One row: the greatest ``column``, or 1900-01-01 where ``target`` has none."""
    newest: Column = F.max(column)
    floor = F.lit("1900-01-01").cast(target.schema[column].dataType)
    return target.agg(F.coalesce(newest, floor).alias("watermark"))
