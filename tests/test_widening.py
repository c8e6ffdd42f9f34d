"""Which types may stand in for which, and files that use it."""

from datetime import date
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tests.retail import at, customer
from tests.test_loading import Loader
from tidemill.contracts import CUSTOMER
from tidemill.functions.widening import common_type, widens
from tidemill.sources.files import SchemaDrift, check_schema

# The values of each type that are hardest to keep.
EXTREMES = {
    ByteType(): [-(2**7), 2**7 - 1],
    ShortType(): [-(2**15), 2**15 - 1],
    IntegerType(): [-(2**31), 2**31 - 1],
    LongType(): [-(2**63), 2**63 - 1],
    DecimalType(5, 2): [Decimal("-999.99"), Decimal("999.99")],
    DecimalType(12, 2): [Decimal("-9999999999.99"), Decimal("9999999999.99")],
    DecimalType(12, 4): [Decimal("-99999999.9999"), Decimal("99999999.9999")],
    DecimalType(21, 2): [Decimal("-9999999999999999999.99"), Decimal("9999999999999999999.99")],
    FloatType(): [3.4028234663852886e38, 1.401298464324817e-45],
    DoubleType(): [1.7976931348623157e308, 5e-324, 0.1],
    DateType(): [date(1, 1, 1), date(9999, 12, 31)],
    BooleanType(): [True, False],
    StringType(): ["7", "x"],
}
TYPES = [*EXTREMES, TimestampNTZType()]


def test_what_widens_keeps_every_value(spark):
    for have, want in product(EXTREMES, TYPES):
        rows = spark.createDataFrame([(v,) for v in EXTREMES[have]], StructType([StructField("v", have)]))
        if widens(have, want):
            back = rows.select("v", F.col("v").cast(want).cast(have).alias("b"))
            assert all(v == b for v, b in back.collect()), (have, want)


def test_what_widens_in_full():
    pairs = {(a.simpleString(), b.simpleString()) for a, b in product(TYPES, TYPES) if a != b and widens(a, b)}
    small, big, fine, huge = "decimal(5,2)", "decimal(12,2)", "decimal(12,4)", "decimal(21,2)"
    longer = {
        "tinyint": ["smallint", "int", "bigint", small, big, fine, huge, "float", "double"],
        "smallint": ["int", "bigint", big, fine, huge, "float", "double"],
        "int": ["bigint", big, huge, "double"],
        "bigint": [huge],
        small: [big, fine, huge],
        big: [huge],
        "float": ["double"],
        "date": ["timestamp_ntz"],
    }
    assert pairs == {(a, b) for a, all_b in longer.items() for b in all_b}


def test_common_type():
    for a, b in product(TYPES, TYPES):
        both = common_type(a, b)
        assert both == common_type(b, a)
        assert both is None or (widens(a, both) and widens(b, both))
    assert common_type(IntegerType(), DecimalType(6, 2)) == DecimalType(12, 2)
    assert common_type(DecimalType(5, 2), DecimalType(12, 4)) == DecimalType(12, 4)
    assert common_type(IntegerType(), FloatType()) == DoubleType()
    assert common_type(DecimalType(38, 0), DecimalType(38, 30)) is None
    assert common_type(LongType(), DoubleType()) is None
    assert common_type(StringType(), IntegerType()) is None


def retyped(column, kind, *more):
    fields = [StructField(column, kind) if f.name == column else f for f in CUSTOMER.schema]
    return StructType([*fields, *more])


def test_check_schema_widens_only_where_asked():
    narrow = retyped("customer_id", ShortType())
    check_schema(narrow, CUSTOMER, allow_widening=True)
    with pytest.raises(SchemaDrift, match="customer_id is smallint, expected int"):
        check_schema(narrow, CUSTOMER)
    with pytest.raises(SchemaDrift, match="customer_id is bigint, expected int"):
        check_schema(retyped("customer_id", LongType()), CUSTOMER, allow_widening=True)


@pytest.fixture
def loader(spark, tmp_path):
    return Loader(spark, tmp_path)


WIDE = {"allow_new_columns": True, "allow_widening": True}


def test_narrow_files_load_and_lossy_ones_fail_alone(loader):
    row = customer(1, at(1))
    loader.land("customer_20260801_full.parquet", [row])
    narrow = [(2, *row[1:]), (None, *row[1:])]
    loader.land("customer_20260802_full.parquet", narrow, retyped("customer_id", ShortType()))
    loader.land("customer_20260803_full.parquet", [(3, *row[1:])], retyped("customer_id", LongType()))
    day = [*row[:6], date(2026, 8, 4), row[7]]
    loader.land("customer_20260804_full.parquet", [(4, *day[1:])], retyped("created_at", DateType()))
    loader.store("first")
    with pytest.raises(SchemaDrift, match="customer_id is bigint, expected int"):
        loader.ingest("first", **WIDE)
    held = {r.customer_id: r.created_at for r in loader.history().collect()}
    assert set(held) == {None, 1, 2, 4}
    midnight = loader.history().where("customer_id = 4 AND created_at = date_trunc('DAY', created_at)")
    assert midnight.count() == 1
    assert loader.history().schema["customer_id"].dataType == IntegerType()
    states = {r.source_file[-21:]: r.status for r in loader.ledger().collect()}
    assert sorted(states.values()) == ["FAILED", "SUCCESS", "SUCCESS", "SUCCESS"]


def test_new_columns_get_the_type_that_holds_all(loader):
    def land(day, kind, value):
        schema = StructType([*CUSTOMER.schema, StructField("score", kind)])
        name = f"customer_202608{day:02}_full.parquet"
        loader.land(name, [(*customer(day, at(1)), value)], schema)

    def scores():
        return {r.customer_id: r.score for r in loader.history().collect()}

    land(1, IntegerType(), 7)
    land(2, DecimalType(4, 2), Decimal("1.25"))
    land(3, StringType(), "high")
    loader.store("first")
    with pytest.raises(SchemaDrift, match=r"score is string, expected decimal\(12,2\)"):
        loader.ingest("first", **WIDE)
    assert scores() == {1: Decimal(7), 2: Decimal("1.25")}
    # What the history has by now stays: narrower loads, finer does not, and neither does the text.
    land(4, ShortType(), 3)
    land(5, DecimalType(6, 3), Decimal("0.125"))
    loader.store("second")
    with pytest.raises(SchemaDrift, match=r"score is decimal\(6,3\), expected decimal\(12,2\)"):
        loader.ingest("second", **WIDE)
    assert scores() == {1: Decimal(7), 2: Decimal("1.25"), 4: Decimal(3)}
    assert loader.history().schema["score"].dataType == DecimalType(12, 2)


def test_only_a_refused_file(loader):
    wide = retyped("customer_id", LongType(), StructField("score", StringType()))
    loader.land("customer_20260801_full.parquet", [(*customer(1, at(1)), "x")], wide)
    loader.store("first")
    with pytest.raises(SchemaDrift, match="customer_id is bigint"):
        loader.ingest("first", **WIDE)
    assert loader.history().isEmpty() and "score" not in loader.history().columns
