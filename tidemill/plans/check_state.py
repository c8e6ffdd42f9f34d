"""Declared data tests of relations that only grow, kept up to date batch by batch.

What the checks need of all rows seen so far is kept in a store, in ranges of values: how often each key
came, and the rows whose parent has not come yet. A batch is merged into the ranges it touches; neither
earlier rows nor other ranges are read. Numbers of violations only change by what the touched ranges had
before and have after, so the report is the one before with differences added.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

from tidemill.contracts import Checks
from tidemill.operators.quality import not_null
from tidemill.operators.union import union_all
from tidemill.plans.build import RANGE_WIDTH
from tidemill.plans.snapshot import touched_ranges
from tidemill.session import work_dir, written
from tidemill.sources.snapshots import RANGE, Snapshot, Store, TableMap

REPORT = "check_report"
WHOLE_NUMBERS = (ByteType, ShortType, IntegerType, LongType)
# Values that are not whole numbers have no ranges of their own; they are spread over this many.
HASH_RANGES = 256


def keys_table(relation: str, column: str) -> str:
    return f"keys_{relation}_{column}"


def open_table(relation: str, column: str, parent: str, parent_column: str) -> str:
    return f"open_{relation}_{column}_{parent}_{parent_column}"


def _range(data_type: DataType, width: int) -> Column:
    if isinstance(data_type, WHOLE_NUMBERS):
        return F.expr(f"value div {width}").cast("string").alias(RANGE)
    return F.pmod(F.xxhash64("value"), F.lit(HASH_RANGES)).cast("string").alias(RANGE)


def _ranged(values: DataFrame, width: int) -> DataFrame:
    return values.withColumn(RANGE, _range(values.schema["value"].dataType, width))


def counted(rows: DataFrame, column: str) -> DataFrame:
    """Each non-null value and its number of rows; counted before the shuffle."""
    values = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return values.agg(F.count(F.lit(1)).alias("n"))


def _stored(base: Snapshot, table: str, like: DataFrame, ranges: list[str]) -> DataFrame:
    if table not in base.tables:
        return like.limit(0)
    return base.read(like.sparkSession, table, ranges)


def _added(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("value").agg(F.sum("n").alias("n"))


def _difference(
    check: str,
    relation: str,
    column: str,
    before: DataFrame,
    after: DataFrame,
    total: Column,
    parent: str = "",
) -> DataFrame:
    """How much ``total`` over the ``after`` ranges exceeds the one over the ``before`` ranges."""
    sides = before.select(F.lit(-1).alias("sign"), "n").union(after.select(F.lit(1), "n"))
    more = F.coalesce(F.sum(F.col("sign") * total), F.lit(0)).alias("violations")
    names = {"check_name": check, "relation": relation, "column": column, "parent": parent}
    return sides.agg(more).withColumns({k: F.lit(v) for k, v in names.items()})


def key_columns(checks: Mapping[str, Checks]) -> Iterator[tuple[str, str]]:
    """Columns whose values are counted: those declared unique, and those that others refer to."""
    own = [(name, c) for name, declared in checks.items() for c in declared.unique]
    parents = [(p, pc) for declared in checks.values() for _, p, pc in declared.relationships]
    yield from dict.fromkeys([*own, *parents])


def merge_keys(
    store: Store, base: Snapshot, new: DataFrame, table: str, width: int
) -> tuple[TableMap, list[str]]:
    """The counts of a key column with those of ``new`` added, and the ranges this touched."""
    new = _ranged(new, width)
    ranges = touched_ranges(new)
    merged = _added(_stored(base, table, new.drop(RANGE), ranges), new.drop(RANGE))
    return store.ranges(_ranged(merged, width), table, ranges, base.tables.get(table)), ranges


def merge_open(
    store: Store,
    base: Snapshot,
    view: Snapshot,
    children: DataFrame,
    arrived: DataFrame | None,
    table: str,
    parents: str,
    width: int,
) -> tuple[TableMap, list[str]]:
    """The values without a parent, with their rows: those of ``children`` whose parent is not in
    ``view`` come in, those whose parent has ``arrived`` go. Also the ranges this touched."""
    children = _ranged(children, width)
    known = _stored(view, parents, children.drop(RANGE), touched_ranges(children))
    lost = children.join(known.select("value"), "value", "left_anti")
    ranges = set(touched_ranges(lost))
    held = base.tables.get(table)
    if arrived is not None and held is not None:
        ranges |= set(touched_ranges(_ranged(arrived, width))) & set(held.folders)
    names = sorted(ranges)
    before = _stored(base, table, children.drop(RANGE), names)
    if arrived is not None:
        before = before.join(arrived.select("value"), "value", "left_anti")
    merged = _added(before, lost.drop(RANGE))
    return store.ranges(_ranged(merged, width), table, names, held), names


def _same_kind(children: DataFrame, parents: DataType, name: str) -> None:
    own = children.schema["value"].dataType
    if own != parents and not all(isinstance(t, WHOLE_NUMBERS) for t in (own, parents)):
        raise TypeError(f"{name}: {own.simpleString()} refers to {parents.simpleString()}")


def update_checks(
    store: Store,
    news: Mapping[str, DataFrame],
    checks: Mapping[str, Checks],
    batch: str,
    width: int = RANGE_WIDTH,
) -> Snapshot:
    """Merge the new rows of relations into the state of the checks and publish it in one step.

    The report then equals ``run_checks`` over all rows of all batches, for the relations that had any
    batch; a parent that never came has no keys. A batch that is in the state is not merged again. Each
    new relation is read once for its nulls and once for each column that is counted. On the driver are
    the names of ranges and the batch ids.
    """
    spark, base = store.spark, store.current()
    held = base.tables.get(REPORT)
    batches = list(held.notes["batches"]) if held else []
    if batch in batches:
        return base
    work = work_dir(spark)
    differences = [base.read(spark, REPORT)] if held else []
    for name, declared in checks.items():
        if name in news and declared.not_null:
            nulls = not_null(news[name], name, declared.not_null)
            differences.append(nulls.withColumn("parent", F.lit("")))
    changes: dict[str, TableMap] = {}
    new: dict[str, DataFrame] = {}
    for name, column in key_columns(checks):
        if name not in news:
            continue
        table = keys_table(name, column)
        new[table] = written(counted(news[name], column), f"{work}/{table}")
        changes[table], ranges = merge_keys(store, base, new[table], table, width)
        if column in checks.get(name, Checks()).unique:
            before = _stored(base, table, new[table], ranges)
            after = base.changed(changes).read(spark, table, ranges)
            repeated = (F.col("n") > 1).cast("long")
            differences.append(_difference("unique", name, column, before, after, repeated))
    view = base.changed(changes)
    for name, declared in checks.items():
        for column, parent, parent_column in declared.relationships:
            table, parents = open_table(name, column, parent, parent_column), keys_table(parent, parent_column)
            arrived = new.get(parents)
            if name in news:
                children = written(counted(news[name], column), f"{work}/{table}")
            elif table in base.tables and arrived is not None:
                children = base.read(spark, table, [])
            else:
                continue
            if parents in view.tables:
                _same_kind(children, view.tables[parents].schema["value"].dataType, table)
            changes[table], ranges = merge_open(
                store, base, view, children, arrived, table, parents, width
            )
            before = _stored(base, table, children, ranges)
            after = base.changed(changes).read(spark, table, ranges)
            differences.append(
                _difference("relationships", name, column, before, after, F.col("n"), parents)
            )
    if differences:
        by = ("check_name", "relation", "column", "parent")
        report = union_all(differences).groupBy(*by).agg(F.sum("violations").alias("violations"))
        changes[REPORT] = store.whole(report.coalesce(1), REPORT, batches=[*batches, batch])
    return store.publish(base, changes)


def check_report(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """One row per declared check: check_name, relation, column, violations, as ``run_checks``."""
    return snapshot.read(spark, REPORT).drop("parent")


def open_orphans(
    spark: SparkSession,
    snapshot: Snapshot,
    relation: str,
    column: str,
    parent: str,
    parent_column: str,
) -> DataFrame:
    """Values without a parent so far, with the number of their rows, as ``orphans``."""
    held = snapshot.read(spark, open_table(relation, column, parent, parent_column))
    return held.select(F.col("value").alias(column), F.col("n").alias("rows"))
