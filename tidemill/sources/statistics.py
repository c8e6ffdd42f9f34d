"""Statistics of history files, by which a scan leaves out files that cannot hold what it asks for.

A batch's statistics are two tables beside the history, partitioned by batch like it. One has a row for
each data file: its number of rows, and its smallest and largest key and time. The other has a Bloom
filter of the file's keys, cut into blocks of 4 KB. All bits of a key are in one block, so a lookup needs
one block of each file; blocks are stored in their order, and a block without any bit is not stored.
"""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemill.contracts import VERSION_ORDER, Entity
from tidemill.sources.tables import (
    Lakehouse,
    create_if_missing,
    loaded_batches,
    write_batch,
)

TIME = VERSION_ORDER[0]
BLOCK_BITS = 32_768  # what one bitmap aggregate holds
BITS_PER_ROW = 10
BITS_PER_KEY = 5
# Powers of two a number of blocks may be; a lookup asks for its block under each of them.
BLOCK_POWERS = 40


def files_table(lake: Lakehouse, entity: Entity) -> str:
    return f"{lake.history(entity)}__files"


def blooms_table(lake: Lakehouse, entity: Entity) -> str:
    return f"{lake.history(entity)}__blooms"


def has_statistics(spark: SparkSession, lake: Lakehouse, entity: Entity) -> bool:
    return spark.catalog.tableExists(files_table(lake, entity))


def prepare_statistics(spark: SparkSession, lake: Lakehouse, entity: Entity) -> None:
    """Create the two tables of an entity, unless they are there."""
    key, time = (entity.schema[c].dataType for c in (entity.key, TIME))
    batch = StructField("_batch_id", StringType())
    files = [
        StructField("file_name", StringType()),
        StructField("row_count", LongType()),
        StructField("key_min", key),
        StructField("key_max", key),
        StructField("time_min", time),
        StructField("time_max", time),
        batch,
    ]
    blooms = [
        StructField("file_name", StringType()),
        StructField("blocks", LongType()),
        StructField("block", LongType()),
        StructField("bits", BinaryType()),
        batch,
    ]
    by = ("_batch_id",)
    create_if_missing(spark, files_table(lake, entity), StructType(files), partition_by=by)
    create_if_missing(spark, blooms_table(lake, entity), StructType(blooms), partition_by=by)


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _bits(key: Column) -> list[Column]:
    """The places of a key's bits in its block."""
    return [F.pmod(F.xxhash64(F.lit(n), key), F.lit(BLOCK_BITS)) for n in range(1, BITS_PER_KEY + 1)]


def write_statistics(spark: SparkSession, lake: Lakehouse, entity: Entity, batch_id: str) -> None:
    """Write the statistics of a batch from its files; those of an earlier attempt are replaced.

    Only key and time are read, twice. Each file's rows and each block's bits are combined before the
    shuffle, so a file of any size sends a row for each of its tasks and blocks.
    """
    batch = spark.table(lake.history(entity)).where(F.col("_batch_id") == batch_id)
    rows = batch.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col(entity.key).alias("key"),
        F.col(TIME).alias("time"),
    )
    files = rows.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("key").alias("key_min"),
        F.max("key").alias("key_max"),
        F.min("time").alias("time_min"),
        F.max("time").alias("time_max"),
    )
    prepare_statistics(spark, lake, entity)
    write_batch(files, files_table(lake, entity), batch_id)
    held = spark.table(files_table(lake, entity)).where(F.col("_batch_id") == batch_id)
    most = held.agg(F.max("row_count")).scalar()
    wanted = most * F.lit(BITS_PER_ROW) / F.lit(BLOCK_BITS)
    power = F.greatest(F.ceil(F.log2(wanted)), F.lit(0))
    blocks = F.coalesce(F.pow(F.lit(2.0), power), F.lit(1.0)).cast("long")
    keys = rows.where(F.col("key").isNotNull()).withColumn("blocks", blocks)
    placed = keys.select(
        "file_name",
        "blocks",
        F.pmod(_hash(F.col("key")), F.col("blocks")).alias("block"),
        F.explode(F.array(*_bits(F.col("key")))).alias("bit"),
    )
    blooms = placed.groupBy("file_name", "blocks", "block").agg(
        F.bitmap_construct_agg(F.col("bit")).alias("bits")
    )
    write_batch(blooms.sortWithinPartitions("block"), blooms_table(lake, entity), batch_id)


def _has_bit(bits: Column, place: int) -> Column:
    byte = F.conv(F.hex(F.substring(bits, place // 8 + 1, 1)), 16, 10).cast(IntegerType())
    return byte.bitwiseAND(F.lit(1 << place % 8)) != 0


def with_key(files: DataFrame, blooms: DataFrame, value: Any) -> DataFrame:
    """The files that may hold ``value`` as a key; about one in a hundred of them does not."""
    spark, key_type = files.sparkSession, files.schema["key_min"].dataType
    typed = F.lit(value).try_cast(key_type)
    probe = spark.range(1).select(
        (typed == F.lit(value)).alias("fits"), _hash(typed).alias("hash"), F.array(*_bits(typed)).alias("bits")
    )
    asked = probe.first()
    if not asked.fits:  # null, or no value of the key's type
        return files.limit(0)
    own = {asked.hash % 2**power for power in range(BLOCK_POWERS + 1)}
    here = F.col("block").isin(*own) & (F.col("block") == F.pmod(F.lit(asked.hash), F.col("blocks")))
    for place in asked.bits:
        here &= _has_bit(F.col("bits"), place)
    near = files.where((F.col("key_min") <= typed) & (F.col("key_max") >= typed))
    return near.join(blooms.where(here), ["_batch_id", "file_name"], "left_semi")


def history_where(
    spark: SparkSession,
    lake: Lakehouse,
    entity: Entity,
    key: Any = None,
    after: datetime | Column | None = None,
    upto: datetime | Column | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """Committed history rows of one key, or of times after ``after`` and up to ``upto``, or both.

    The same rows as the same conditions on ``committed_history``, but only files are opened that can
    hold such rows. Rows of a null key or time are never asked for. Batches without statistics are read
    by the conditions alone. To the driver come the names of the files to read, which any plan of a scan
    has there, and the ids of batches without statistics.
    """
    history = spark.table(lake.history(entity))
    found = F.lit(True)
    if key is not None:
        found &= F.col(entity.key) == F.lit(key)
    if after is not None:
        found &= F.col(TIME) > F.lit(after)
    if upto is not None:
        found &= F.col(TIME) <= F.lit(upto)
    loaded = loaded_batches(spark, lake) if batches is None else batches
    own = loaded.where(
        (F.col("source_name") == entity.source) & (F.col("table_name") == entity.table)
    ).select(F.col("batch_id").alias("_batch_id"))
    if has_statistics(spark, lake, entity):
        files = spark.table(files_table(lake, entity)).join(own, "_batch_id", "left_semi")
        bare = own.join(files, "_batch_id", "left_anti")
    else:
        files, bare = None, own
    plain = [r[0] for r in bare.distinct().toLocalIterator()]
    parts = [history.where(F.col("_batch_id").isin(*plain) & found)]
    if files is not None:
        if after is not None:
            files = files.where(F.col("time_max") > F.lit(after))
        if upto is not None:
            files = files.where(F.col("time_min") <= F.lit(upto))
        if key is not None:
            files = with_key(files, spark.table(blooms_table(lake, entity)), key)
        chosen = files.select("_batch_id", "file_name").collect()
        # Partitions are pruned by the batch, and their files by the name, before any is opened.
        inside = F.col("_batch_id").isin(*{r[0] for r in chosen})
        named = F.col("_metadata.file_name").isin(*{r[1] for r in chosen})
        parts.append(history.where(inside & named & found))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(*history.columns)
