"""Landing files into the immutable, date-partitioned archive."""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemill.contracts import FAILED, SUCCESS, Entity
from tidemill.operators.digest import NO_ROWS, content_digest
from tidemill.operators.ledger import load_summary
from tidemill.operators.union import union_all
from tidemill.session import work_dir, written
from tidemill.sources.files import (
    FOOTER_THREADS,
    OWN_SCHEMES,
    archive_path,
    classify_files,
    discover_files,
    file_schemas,
)
from tidemill.sources.tables import ARCHIVE_LOG, Lakehouse, append

# Layout of the archive. The last level is one folder per landed file, so a file is a partition.
LAYOUT = ("load_year", "load_month", "load_day", "file_name")


FILE_KEY = ("source_name", "table_name", "file_name")
COPIED = (
    "file_name string, rows_landed long, rows_archived long, complete boolean, "
    "content_digest string, source_name string, table_name string, file_schema string"
)
COMPARED = "source_name string, table_name string, file_name string, found_digest string"
FAILURES = (
    "source_name string, table_name string, file_name string, file_schema string, "
    "copy_error string"
)


class ArchiveFailed(RuntimeError):
    """Some files could not be archived. The others were."""


def archive_root(root: str, entity: Entity) -> str:
    return f"{root.rstrip('/')}/{entity.source}/{entity.table}"


def decide(files: DataFrame, archived: DataFrame) -> DataFrame:
    """What to do with each landed file: copy it, accept it as archived before, or fail it.

    ``archived`` has one row (FILE_KEY, archived_size, changed_before, digest_before) per file in the
    archive. The archive is never changed: a file that comes again fails if its size is another one.
    It is accepted if it has not been changed since; else its content is to be compared, if that of
    the archived one is known. Several files of one name, possible below a folder tree, all fail.
    """
    namesakes = F.count(F.lit(1)).over(Window.partitionBy(*FILE_KEY))
    reason = F.when(namesakes > 1, F.lit("file name occurs in several folders"))
    files = files.withColumn("reject_reason", F.coalesce("reject_reason", reason))
    again = F.col("archived_size").isNotNull()
    same = F.col("archived_size") == F.col("size_bytes")
    untouched = F.coalesce(F.col("changed_before") == F.col("changed_at"), F.lit(False))
    action = (
        F.when(F.col("reject_reason").isNotNull(), F.lit("reject"))
        .when(again & same & (untouched | F.col("digest_before").isNull()), F.lit("accept"))
        .when(again & same, F.lit("compare"))
        .when(again, F.lit("conflict"))
        .otherwise(F.lit("copy"))
    )
    return files.join(archived, list(FILE_KEY), "left").withColumn("action", action)


def layout_columns(day: str) -> dict[str, Column]:
    return {
        "load_year": F.date_format(day, "yyyy"),
        "load_month": F.date_format(day, "MM"),
        "load_day": F.date_format(day, "dd"),
    }


def write_archive(rows: DataFrame, path: str) -> None:
    """Write rows that carry the LAYOUT columns. No shuffle: a task writes what it read. Only the
    files at hand are replaced, so repeating an interrupted write leaves no copies."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAYOUT)
        .parquet(path)
    )


def reconcile(landed: DataFrame, stored: DataFrame) -> DataFrame:
    """Per file: rows_landed, rows_archived and whether they agree. Both inputs have file_name; only
    file footers are read to count Parquet rows by file."""
    count = F.count(F.lit(1))
    before = landed.groupBy("file_name").agg(count.alias("rows_landed"))
    after = stored.groupBy("file_name").agg(count.alias("rows_archived"))
    both = before.join(after, "file_name", "full_outer").na.fill(0)
    return both.withColumn("complete", F.col("rows_landed") == F.col("rows_archived"))


def footers(spark: SparkSession, uris: list[str]) -> dict[str, tuple[str | None, str | None]]:
    """The schema of each file, or why it cannot be read. Tasks read them where they can."""
    if all(urlparse(uri).scheme in OWN_SCHEMES for uri in uris):
        return file_schemas(spark, uris, f"{work_dir(spark)}/footers") if uris else {}

    def look(uri: str) -> tuple[str | None, str | None]:
        try:
            return spark.read.parquet(uri).schema.json(), None
        except (PySparkException, Py4JJavaError) as failure:
            return None, f"cannot be read: {failure}"

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        return dict(zip(uris, pool.map(look, uris)))


def archive_landing(
    spark: SparkSession,
    lake: Lakehouse,
    landing: str,
    archive: str,
    entities: tuple[Entity, ...],
    batch_id: str,
    now: datetime,
    recursive: bool = False,
) -> DataFrame:
    """Archive the new files of all entities and log one row per landed file. Returns these rows.

    Files are expected in their entity's landing folder, or with ``recursive`` anywhere below it, as
    in an existing ``yyyy/mm/dd`` tree to be taken over. Every file fails on its own, whatever is
    wrong with it: its name, its size, its content, or that it went away before it was read. Files of
    one schema are copied together, each exactly as it is. The caller removes landed files when it
    likes: repeating this is a no-op for them.

    The driver holds a row for each file that is new in this run.
    """
    work = work_dir(spark)
    log = spark.table(lake.archive_log).where(F.col("status") == SUCCESS)
    archived = log.groupBy(*FILE_KEY).agg(
        F.max("size_bytes").alias("archived_size"),
        F.max("rows_archived").alias("rows_before"),
        F.max("file_schema").alias("schema_before"),
        # Accepted again, a file has the time it had then.
        F.max("changed_at").alias("changed_before"),
        F.max("content_digest").alias("digest_before"),
    )
    found = [
        classify_files(
            discover_files(spark, archive_root(landing, e), recursive), e.source, e.table
        )
        for e in entities
    ]
    # One listing for the whole run: files that land meanwhile wait for the next one.
    decided = written(decide(union_all(found), archived), f"{work}/decided")
    known = decided.where("action IN ('copy', 'compare')").select(
        *FILE_KEY, "uri", "source_date", "action", "schema_before"
    )
    known = known.collect()
    seen = footers(spark, [r.uri for r in known])
    new = [r for r in known if r.action == "copy"]
    compared, unread = compare_files(spark, [r for r in known if r.action == "compare"], seen)
    done: list[DataFrame] = [spark.createDataFrame([], COPIED)]
    failed = [(*r[:3], None, seen[r.uri][1]) for r in new if seen[r.uri][0] is None] + unread
    groups: dict[tuple, list[Row]] = {}
    for row in new:
        if seen[row.uri][0] is not None:
            groups.setdefault((row.source_name, row.table_name, seen[row.uri][0]), []).append(row)
    for (source, table, schema), files in groups.items():
        entity = next(e for e in entities if (e.source, e.table) == (source, table))
        counts, errors = copy_files(spark, archive_root(archive, entity), schema, files)
        failed += errors
        if counts is not None:
            names = {"source_name": source, "table_name": table, "file_schema": schema}
            done.append(counts.withColumns({k: F.lit(v) for k, v in names.items()}))
    checked = union_all(done).withColumn("copy_error", F.lit(None).cast("string"))
    lost = spark.createDataFrame(failed, FAILURES)
    checked = checked.unionByName(lost, allowMissingColumns=True)

    results = decided.join(checked, list(FILE_KEY), "left").join(compared, list(FILE_KEY), "left")
    same = F.coalesce(F.col("found_digest") == F.col("digest_before"), F.lit(False))
    accepted = (F.col("action") == "accept") | ((F.col("action") == "compare") & same)
    # Without a count of its own, no file has been copied.
    ok = accepted | ((F.col("action") == "copy") & F.coalesce("complete", F.lit(False)))
    message = (
        F.when(F.col("action") == "reject", F.col("reject_reason"))
        .when(F.col("action") == "accept", F.lit("already archived, same size"))
        .when(accepted, F.lit("already archived, same content"))
        .when(F.col("action") == "conflict", F.lit("already archived with another size"))
        .when(
            F.col("action") == "compare",
            F.coalesce("copy_error", F.lit("already archived with other content")),
        )
        .when(ok, F.lit("archived, row counts agree"))
        .otherwise(F.coalesce("copy_error", F.lit("row counts differ after the copy")))
    )
    values = {
        "source_file": archive_path(
            F.col("source_name"), F.col("table_name"), F.col("source_date"), F.col("file_name")
        ),
        "rows_archived": F.when(accepted, F.col("rows_before")).when(ok, F.col("rows_archived")),
        "file_schema": F.when(accepted, F.col("schema_before")).otherwise(F.col("file_schema")),
        "content_digest": F.when(accepted, F.col("digest_before")).when(ok, F.col("content_digest")),
        "status": F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAILED)),
        "message": message,
        "batch_id": F.lit(batch_id),
        "archived_at": F.lit(now),
    }
    entry = written(
        results.select(
            *(
                values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                for f in ARCHIVE_LOG.fields
            )
        ),
        f"{work}/results",
    )
    append(entry, lake.archive_log)
    return entry


def copy_files(
    spark: SparkSession, target_root: str, schema: str, files: list[Row]
) -> tuple[DataFrame | None, list[tuple]]:
    """Copy files of one schema. Returns the rows of each, counted on both sides, and the files that
    failed. If the copy breaks, files that can no longer be read fail and the others are copied
    again; if all can be read, the copy fails for all of them."""
    errors: list[tuple] = []
    while files:
        try:
            rows = landed_rows(spark, schema, files)
            write_archive(rows, target_root)
            filled = {r[0] for r in rows.select("file_name").distinct().collect()}
            full = [f for f in files if f.file_name in filled]
            stored = archived_rows(spark, target_root, full)
            counts = reconcile(rows, stored)
            if full:
                held = archived_content(spark, target_root, schema, full, stored)
                counts = counts.join(held, "file_name", "left")
            else:
                counts = counts.withColumn("content_digest", F.lit(None).cast("string"))
            counts = written(counts, f"{work_dir(spark)}/counts")
            break
        except (PySparkException, Py4JJavaError) as failure:
            again = footers(spark, [f.uri for f in files])
            broken = [f for f in files if again[f.uri][0] != schema]
            reason = {f.uri: again[f.uri][1] or "changed while it was copied" for f in broken}
            for file in broken or files:
                errors.append((*file[:3], schema, reason.get(file.uri, f"copy failed: {failure}")))
            files = [f for f in files if f not in broken] if broken else []
    if not files:
        return None, errors
    # A file without a row in the copy is complete if it can be read and has none.
    empty = []
    for file in (f for f in files if f.file_name not in filled):
        try:
            scan = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(file.uri)
            if scan.isEmpty():
                empty.append((file.file_name, 0, 0, True, NO_ROWS))
        except (PySparkException, Py4JJavaError) as failure:
            errors.append((*file[:3], schema, f"cannot be read: {failure}"))
    return counts.unionByName(spark.createDataFrame(empty, counts.schema)), errors


def compare_files(
    spark: SparkSession, files: list[Row], seen: dict[str, tuple[str | None, str | None]]
) -> tuple[DataFrame, list[tuple]]:
    """The digests of files that came again and were changed, and the files that could not be read.
    One whose columns differ from the archived ones has no digest, nor is it read for one."""
    failed = [(*f[:3], None, seen[f.uri][1]) for f in files if seen[f.uri][0] is None]
    groups: dict[tuple, list[Row]] = {}
    for file in files:
        if seen[file.uri][0] is not None and seen[file.uri][0] == file.schema_before:
            groups.setdefault((*file[:2], file.schema_before), []).append(file)
    found = [spark.createDataFrame([], COMPARED)]
    names_type = ", ".join(f"{c} string" for c in FILE_KEY)
    for (_, _, schema), own in groups.items():
        columns = StructType.fromJson(json.loads(schema))
        scan = spark.read.schema(columns).parquet(*(f.uri for f in own))
        rows = scan.select(*scan.columns, F.col("_metadata.file_name").alias("file_name"))
        try:
            digests = written(content_digest(rows, ["file_name"]), f"{work_dir(spark)}/digests")
        except (PySparkException, Py4JJavaError) as failure:
            failed += [(*f[:3], schema, f"cannot be read: {failure}") for f in own]
            continue
        names = spark.createDataFrame([tuple(f[:3]) for f in own], names_type)
        digest = F.coalesce("content_digest", F.lit(NO_ROWS)).alias("found_digest")
        found.append(names.join(digests, "file_name", "left").select(*FILE_KEY, digest))
    return union_all(found), failed


def archived_content(
    spark: SparkSession, target_root: str, schema: str, files: list[Row], stored: DataFrame
) -> DataFrame:
    """file_name and content_digest of what was just archived of ``files``, read from the archive."""
    columns = StructType.fromJson(json.loads(schema))
    layout = [StructField(c, StringType()) for c in LAYOUT]
    scan = (
        spark.read.schema(StructType([*columns.fields, *layout]))
        .option("basePath", target_root)
        .parquet(*day_folders(target_root, (f.source_date for f in files)))
    )
    own = stored.select(*LAYOUT).distinct()
    rows = scan.join(own, list(LAYOUT), "left_semi").drop(*LAYOUT[:-1])
    return content_digest(rows, ["file_name"])


def landed_rows(spark: SparkSession, schema: str, files: list[Row]) -> DataFrame:
    """Rows of the landed ``files``, which have one schema and different names, each with its file's
    name and date parts."""
    columns = StructType.fromJson(json.loads(schema))
    scan = spark.read.schema(columns).parquet(*(f.uri for f in files))
    days = spark.createDataFrame(
        [(f.file_name, f.source_date) for f in files], "file_name string, source_date date"
    )
    rows = scan.select("*", F.col("_metadata.file_name").alias("file_name"))
    return (
        rows.join(days, "file_name")
        .withColumns(layout_columns("source_date"))
        .select(*scan.columns, *LAYOUT)
    )


def day_folders(root: str, days: Iterable[date]) -> list[str]:
    parts = "load_year={0:%Y}/load_month={0:%m}/load_day={0:%d}"
    return [f"{root}/{parts.format(day)}" for day in sorted(set(days))]


def archived_rows(spark: SparkSession, target_root: str, files: list[Row]) -> DataFrame:
    """The LAYOUT columns of every archived row of ``files``. Only the days of these files are
    listed, and within them the join prunes to the files' own partitions."""
    layout = StructType([StructField(c, StringType()) for c in LAYOUT])
    if not files:
        return spark.createDataFrame([], layout)
    stored = (
        spark.read.schema(layout)
        .option("basePath", target_root)
        .parquet(*day_folders(target_root, (f.source_date for f in files)))
    )
    keys = [(*f"{x.source_date:%Y %m %d}".split(), x.file_name) for x in files]
    return stored.join(spark.createDataFrame(keys, layout), list(LAYOUT), "left_semi")


def archive_all(
    spark: SparkSession,
    lake: Lakehouse,
    landing: str,
    archive: str,
    entities: tuple[Entity, ...],
    batch_id: str,
    now: datetime,
    recursive: bool = False,
) -> DataFrame:
    """Archive every entity, then raise if any file failed. Returns the summary."""
    results = archive_landing(
        spark, lake, landing, archive, entities, batch_id, now, recursive
    )
    summary = load_summary(results)
    failed = summary.first()["failed"]
    if failed:
        raise ArchiveFailed(f"{failed} file(s) were not archived; they stay in the landing folder")
    return summary
