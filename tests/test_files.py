from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.retail import customer, land_file, at
from tidemill.contracts import CUSTOMER
from tidemill.sources.files import (
    SchemaDrift,
    archive_path,
    check_schema,
    classify_files,
    discover_files,
    plain_path,
    read_files,
)

NAMES = {
    "customer_20260820_full.parquet": (date(2026, 8, 20), "full", None),
    "Customer_20260820_INCREMENTAL.PARQUET": (date(2026, 8, 20), "incremental", None),
    "product_20260820_full.parquet": (date(2026, 8, 20), "full", "another table"),
    "customer_20261399_full.parquet": (None, "full", "not a date"),
    "customer_20260230_full.parquet": (None, "full", "not a date"),
    "customer_2026082_full.parquet": (None, None, "convention"),
    "customer_20260820_delta.parquet": (None, None, "convention"),
    "customer_20260820_full.parquet.tmp": (None, None, "convention"),
    "_20260820_full.parquet": (None, None, "convention"),
    "a_20200101_b_20260820_full.parquet": (date(2026, 8, 20), "full", "another table"),
}


def test_names_are_classified(spark):
    files = spark.createDataFrame([(n,) for n in NAMES], "file_name string")
    for row in classify_files(files, "crm", "customer").collect():
        day, load_type, reason = NAMES[row.file_name]
        assert (row.source_date, row.load_type) == (day, load_type), row.file_name
        assert (reason or "") in (row.reject_reason or ""), row
        assert (reason is None) == (row.reject_reason is None), row


def test_table_part_is_greedy(spark):
    files = spark.createDataFrame([("a_20200101_b_20260820_full.parquet",)], "file_name string")
    row = classify_files(files, "x", "A_20200101_B").first()
    assert (row.reject_reason, row.source_date) == (None, date(2026, 8, 20))


def test_discovery(spark, tmp_path):
    deep = tmp_path / "a b" / "c"
    deep.mkdir(parents=True)
    for name in ("one.parquet", "two.PARQUET", "three.txt"):
        (deep / name).write_bytes(b"x" * 7)
    (tmp_path / "top.Parquet").write_bytes(b"x")
    found = {r.file_name: r for r in discover_files(spark, str(tmp_path)).collect()}
    assert set(found) == {"one.parquet", "two.PARQUET", "top.Parquet"}
    assert found["one.parquet"].size_bytes == 7
    assert found["one.parquet"].path == f"{deep}/one.parquet"
    flat = discover_files(spark, str(tmp_path), recursive=False)
    assert [r.file_name for r in flat.collect()] == ["top.Parquet"]
    missing = discover_files(spark, f"{tmp_path}/nothing")
    assert missing.isEmpty() and missing.columns == flat.columns


def test_discovery_reads_no_content(spark, tmp_path):
    (tmp_path / "one.parquet").write_bytes(b"x")
    plan = discover_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_listing_and_scan_name_a_file_alike(spark, tmp_path):
    name = "Customer_20260801_FULL.parquet"
    land_file(spark, tmp_path / "a b+c%20d", CUSTOMER, name, [customer(1, at(1))])
    folder = tmp_path / "a b+c%20d" / "crm" / "customer"
    listed = discover_files(spark, str(folder)).first()
    scanned = spark.read.parquet(str(folder)).select("_metadata.file_name")
    assert scanned.first()[0] == listed.file_name == name
    assert listed.path == f"{folder}/{name}"


@pytest.mark.parametrize(
    "path", ["file:/a/b", "file:///a/b", "/a/b", "s3a://a/b", "abfss://a/b", "hdfs://a/b"]
)
def test_plain_path(spark, path):
    assert spark.range(1).select(plain_path(F.lit(path))).first()[0] == "/a/b"


def test_archive_paths_sort_by_date(spark):
    day = F.to_date(F.lit("2026-08-02"))
    path = archive_path(F.lit("crm"), F.lit("customer"), day, F.lit("f.parquet"))
    assert spark.range(1).select(path).first()[0] == "crm/customer/2026/08/02/f.parquet"


def test_files_without_bytes_are_seen(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.parquet", "sub/b.PARQUET", "c.txt", "_d.parquet", ".e.parquet"):
        (tmp_path / name).write_bytes(b"")
    (tmp_path / "f.parquet").write_bytes(b"x")
    found = {r.file_name: r.size_bytes for r in discover_files(spark, str(tmp_path)).collect()}
    assert found == {"a.parquet": 0, "b.PARQUET": 0, "f.parquet": 1}
    flat = discover_files(spark, str(tmp_path), recursive=False)
    assert {r.file_name for r in flat.collect()} == {"a.parquet", "f.parquet"}
    void = flat.where("size_bytes = 0").withColumn("file_name", F.lit("x_20260801_full.parquet"))
    assert classify_files(void, "s", "x").first().reject_reason == "file has no bytes"


def drifted(spark, change):
    return change(spark.createDataFrame([], CUSTOMER.schema)).schema


@pytest.mark.parametrize(
    "change, complaint",
    [
        (lambda d: d.withColumn("extra", F.lit(1)), "unexpected column extra"),
        (lambda d: d.drop("city"), "missing column city"),
        (lambda d: d.withColumn("city", F.lit(1)), "city is int, expected string"),
    ],
)
def test_schema_drift_is_refused(spark, change, complaint):
    with pytest.raises(SchemaDrift, match=complaint):
        check_schema(drifted(spark, change), CUSTOMER)


def test_only_new_columns_may_be_allowed(spark):
    extra = drifted(spark, lambda d: d.withColumn("extra", F.lit(1)))
    check_schema(extra, CUSTOMER, allow_new_columns=True)
    with pytest.raises(SchemaDrift):
        check_schema(drifted(spark, lambda d: d.drop("city")), CUSTOMER, allow_new_columns=True)
    check_schema(drifted(spark, lambda d: d.select(*sorted(d.columns))), CUSTOMER)


def test_extra_column_in_one_of_many_files_is_seen(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/b")
    assert read_files(spark, f"{tmp_path}/a", f"{tmp_path}/b").columns == ["id", "x"]
    spark.range(3).select(F.col("id").cast("string")).write.parquet(f"{tmp_path}/c")
    with pytest.raises(SchemaDrift):
        read_files(spark, f"{tmp_path}/a", f"{tmp_path}/c")
