"""What a set of rows holds, in a few numbers that do not depend on their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

NO_ROWS = "0:0:0"


def _hashable(schema: StructType, name: str) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(schema[name].dataType, MapType):
        return F.array_sort(F.map_entries(column))  # maps have neither a hash nor an order
    return column


def row_hash(schema: StructType, names: Sequence[str], salt: int) -> Column:
    """A 64-bit hash of a row: of the names, nulls and values of its columns, in any column order."""
    parts: list[Column] = [F.lit(salt)]
    for name in sorted(names):
        parts += [F.lit(name), F.col(f"`{name}`").isNull(), _hashable(schema, name)]
    return F.xxhash64(*parts)


def content_digest(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` and content_digest for each group: how many rows it has and two sums of row hashes.

    Sums take repeated rows into account, unlike an exclusive or, and are added up before the shuffle,
    so a group of any size is a row for each task.
    """
    names = [c for c in rows.columns if c not in by]
    sums = [
        F.sum(row_hash(rows.schema, names, salt).cast("decimal(20,0)")).cast("string") for salt in (1, 2)
    ]
    count = F.count(F.lit(1)).cast("string")
    return rows.groupBy(*by).agg(F.concat_ws(":", count, *sums).alias("content_digest"))
