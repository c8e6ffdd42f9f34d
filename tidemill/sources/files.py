"""Discovery and scan of dated Parquet files."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidemill.contracts import FILE_DATE_FORMAT, FILE_NAME_PATTERN, Entity
from tidemill.functions.widening import widens
from tidemill.session import written

MANIFEST = StructType(
    [
        StructField("uri", StringType()),
        StructField("path", StringType()),
        StructField("file_name", StringType()),
        StructField("size_bytes", LongType()),
        StructField("changed_at", TimestampType()),
    ]
)


def plain_path(path: Column) -> Column:
    """A path without its scheme and with one leading slash, however it is spelled (``file:/a``,
    ``file:///a``)."""
    return F.regexp_replace(path, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?/*", "/")


def discover_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """All ``*.parquet`` files under ``root``, whatever the case of the suffix: where to read it from,
    path, file name, size, change time. A missing folder gives an empty manifest.

    This is a scan of the ``binaryFile`` source without its content column, so it lists but opens
    nothing. Spark gives files of zero bytes no task; they are added from the folder's own listing.
    """
    try:
        listing = (
            spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST)
        raise
    found = listing.select(
        F.col("path").alias("uri"), F.col("length"), F.col("modificationTime").alias("changed_at")
    )
    void = zero_byte_files(spark, root, recursive)
    if void:
        found = found.where("length > 0").unionByName(spark.createDataFrame(void, found.schema))
    return found.where(F.lower("uri").like("%.parquet")).select(
        "uri",
        plain_path(F.col("uri")).alias("path"),
        F.substring_index("uri", "/", -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        "changed_at",
    )


def zero_byte_files(spark: SparkSession, root: str, recursive: bool) -> list[tuple]:
    """(uri, 0, change time) of the files without content; hidden ones are left out, as in any scan."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files, out = system.listFiles(path, recursive), []
    while files.hasNext():
        file = files.next()
        if file.getLen() == 0 and file.getPath().getName()[0] not in "._":
            changed = datetime.fromtimestamp(file.getModificationTime() / 1000, timezone.utc)
            out.append((file.getPath().toString(), 0, changed))
    return out


def classify_files(files: DataFrame, source: str, table: str | Column) -> DataFrame:
    """Read table, date and load type out of ``file_name`` and say whether the file may be loaded.

    Adds source_name, table_name, source_date, load_type and reject_reason, which is null for a
    valid file. A bad name is a row to route, not an error.
    """
    expected = table if isinstance(table, Column) else F.lit(table)
    part = [F.regexp_extract("file_name", FILE_NAME_PATTERN, i) for i in range(4)]
    parsed = files.withColumns(
        {
            "source_name": F.lit(source),
            "table_name": expected,
            "source_date": F.try_to_date(part[2], FILE_DATE_FORMAT),
            "load_type": F.nullif(F.lower(part[3]), F.lit("")),
        }
    )
    named_table = part[1]
    reason = (
        F.when(part[0] == "", F.lit("file name does not follow the convention"))
        .when(F.lower(named_table) != F.lower("table_name"), F.lit("file is of another table"))
        .when(F.col("source_date").isNull(), F.lit("file date is not a date"))
    )
    if "size_bytes" in files.columns:
        reason = reason.when(F.col("size_bytes") == 0, F.lit("file has no bytes"))
    return parsed.withColumn("reject_reason", reason)


def archive_path(source: Column, table: Column, day: Column, file_name: Column) -> Column:
    """``source/table/yyyy/mm/dd/file``: the identity of a file. Its text order is date order."""
    return F.concat_ws("/", source, table, F.date_format(day, "yyyy/MM/dd"), file_name)


class SchemaDrift(ValueError):
    """Files do not have the columns the contract asks for."""


def check_schema(
    found: StructType,
    entity: Entity,
    allow_new_columns: bool = False,
    allow_widening: bool = False,
    evolved: StructType = StructType(),
) -> None:
    """Compare column names and types with the contract; order and nullability do not matter.

    With ``allow_widening`` a type will do that the asked one holds every value of. ``evolved`` are
    columns beyond the contract that a file may lack, but not have in a type that does not fit.
    """
    fits = widens if allow_widening else DataType.__eq__
    have = {f.name: f.dataType for f in found.fields}
    want = {f.name: f.dataType for f in entity.schema.fields}
    asked = {**{f.name: f.dataType for f in evolved.fields}, **want}
    problems = [f"missing column {c}" for c in want if c not in have]
    problems += [
        f"column {c} is {have[c].simpleString()}, expected {asked[c].simpleString()}"
        for c in asked
        if c in have and not fits(have[c], asked[c])
    ]
    if not allow_new_columns:
        problems += [f"unexpected column {c}" for c in have if c not in want]
    if problems:
        raise SchemaDrift(f"{entity.name}: {'; '.join(problems)}")


FOOTERS = "uri string, footer string, error string"
# Footers a task reads at a time.
FOOTER_THREADS = 16
# Footers a task has to read, so that it is worth starting.
FOOTERS_PER_TASK = 64
# File systems that tasks can open without Spark.
OWN_SCHEMES = ("", "file", "s3", "s3a", "s3n", "hdfs", "gs", "gcs", "abfs", "abfss")
SPARK_COLUMNS = b"org.apache.spark.sql.parquet.row.metadata"


def footer_text(uri: str) -> str:
    """All of a file's footer that its columns depend on. Raises if there is no such file."""
    scheme, _, rest = uri.partition(":") if re.match("[A-Za-z][A-Za-z0-9+.-]*:", uri) else ("", "", uri)
    if scheme in ("", "file"):
        system, path = pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        system, path = pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
    with system.open_input_file(path) as source:
        found = pq.read_metadata(source)
    own = (found.metadata or {}).get(SPARK_COLUMNS, b"").decode()
    return f"{found.schema.to_arrow_schema().to_string()}\n{str(found.schema).partition(chr(10))[2]}\n{own}"


def _footer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def look(uri: str) -> tuple[str | None, str | None]:
        try:
            return footer_text(uri), None
        except Exception as failure:  # a corrupt file can fail in any way
            return None, f"cannot be read: {failure}"

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        for batch in batches:
            texts, errors = zip(*pool.map(look, batch.column(0).to_pylist()))
            columns = [batch.column(0), pa.array(texts, pa.string()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["uri", "footer", "error"])


def file_schemas(
    spark: SparkSession, uris: Sequence[str], path: str
) -> dict[str, tuple[str | None, str | None]]:
    """The schema of each file, or why it cannot be read.

    Footers are read by tasks and written to ``path``. To the driver come a digest for each file, and
    one file of each different footer, which Spark reads the columns of: it does so for as many files
    as there are ways to be written, not for every file.
    """
    tasks = -(-len(uris) // FOOTERS_PER_TASK)
    most = max(1, spark.sparkContext.defaultParallelism * 4)
    listed = spark.createDataFrame([(u,) for u in uris], "uri string").repartition(
        max(1, min(tasks, most))
    )
    found = written(listed.mapInArrow(_footer_rows, FOOTERS), path)
    found = found.select("uri", F.md5("footer").alias("kind"), "error")
    rows = found.collect()
    files: dict[str, list[str]] = {}
    for row in sorted(rows):
        if row.kind is not None:
            files.setdefault(row.kind, []).append(row.uri)
    out: dict[str, tuple[str | None, str | None]] = {r.uri: (None, r.error) for r in rows}
    for uris_of_kind in files.values():
        schema = None
        for uri in uris_of_kind:  # the first one, unless it went away
            try:
                schema = schema or spark.read.parquet(uri).schema.json()
                out[uri] = schema, None
            except (PySparkException, Py4JJavaError) as failure:
                out[uri] = None, f"cannot be read: {failure}"
    return out


def read_files(spark: SparkSession, *paths: str, **options: str | bool) -> DataFrame:
    """One scan over all ``paths`` with the union of their columns. Footers are merged by a Spark
    job; columns of conflicting types raise."""
    try:
        return spark.read.options(mergeSchema=True, **options).parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        # Spark wraps the conflict that the merging job met.
        if "CANNOT_MERGE" in str(error):
            raise SchemaDrift(str(error)) from error
        raise
