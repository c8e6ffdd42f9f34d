"""Entity contracts: schema, business key, version order, cleaning rules and declared checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# File name convention, ledger states, lineage and ledger columns, money types.
FILE_NAME_PATTERN = r"(?i)^(.+)_(\d{8})_(full|incremental)\.parquet$"
FILE_DATE_FORMAT = "yyyyMMdd"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
MAX_ERROR_LENGTH = 4000
PRICE = DecimalType(12, 2)
PERCENT = DecimalType(5, 2)
AMOUNT = DecimalType(18, 2)
LINEAGE = StructType(
    [
        StructField("_source_file", StringType()),
        StructField("_source_date", DateType()),
        StructField("_load_type", StringType()),
        StructField("_ingested_at", TimestampType()),
        StructField("_batch_id", StringType()),
    ]
)
LEDGER = StructType(
    [
        StructField("source_name", StringType(), False),
        StructField("table_name", StringType(), False),
        StructField("source_file", StringType(), False),
        StructField("source_date", StringType()),
        StructField("load_type", StringType()),
        StructField("batch_id", StringType(), False),
        StructField("started_at", TimestampType(), False),
        StructField("loaded_at", TimestampType()),
        StructField("rows_ingested", LongType()),
        StructField("status", StringType(), False),
        StructField("error_message", StringType()),
    ]
)

# Newest version first; the file decides between versions of the same load, later path wins.
VERSION_ORDER = ("modified_at", "_ingested_at", "_source_file")


@dataclass(frozen=True)
class Entity:
    """One source table: what its files look like and how its current state is derived."""

    source: str
    table: str
    schema: StructType
    key: str
    clean: dict[str, str] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.source}.{self.table}"

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# The four entities, their columns, types, keys and cleaning.
CUSTOMER = Entity(
    source="crm",
    table="customer",
    key="customer_id",
    schema=StructType(
        [
            StructField("customer_id", IntegerType(), False),
            StructField("first_name", StringType()),
            StructField("last_name", StringType()),
            StructField("email", StringType()),
            StructField("city", StringType()),
            StructField("status", StringType()),
            StructField("created_at", TimestampType()),
            StructField("modified_at", TimestampType()),
        ]
    ),
    clean={"first_name": "trim", "last_name": "trim", "email": "lower"},
)

PRODUCT = Entity(
    source="product",
    table="product",
    key="product_id",
    schema=StructType(
        [
            StructField("product_id", IntegerType(), False),
            StructField("product_name", StringType()),
            StructField("category", StringType()),
            StructField("unit_price", PRICE),
            StructField("is_active", BooleanType()),
            StructField("created_at", TimestampType()),
            StructField("modified_at", TimestampType()),
        ]
    ),
    clean={"product_name": "trim", "category": "trim"},
)

ORDERS = Entity(
    source="sales",
    table="orders",
    key="order_id",
    schema=StructType(
        [
            StructField("order_id", IntegerType(), False),
            StructField("customer_id", IntegerType(), False),
            StructField("order_date", DateType()),
            StructField("order_status", StringType()),
            StructField("currency", StringType()),
            StructField("modified_at", TimestampType()),
        ]
    ),
    clean={"order_status": "lower", "currency": "upper"},
)

ORDER_LINE = Entity(
    source="sales",
    table="order_line",
    key="order_line_id",
    schema=StructType(
        [
            StructField("order_line_id", IntegerType(), False),
            StructField("order_id", IntegerType(), False),
            StructField("product_id", IntegerType(), False),
            StructField("quantity", IntegerType()),
            StructField("unit_price", PRICE),
            StructField("discount_pct", PERCENT),
            StructField("modified_at", TimestampType()),
        ]
    ),
)

ENTITIES = (CUSTOMER, PRODUCT, ORDERS, ORDER_LINE)


@dataclass(frozen=True)
class Checks:
    """Declared data tests of one relation; ``relationships`` has (column, parent, its column)."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    relationships: tuple[tuple[str, str, str], ...] = ()


# The declared data tests, per relation.
CHECKS: dict[str, Checks] = {
    "stg_customer": Checks(
        not_null=("customer_id", "email", "modified_at"),
        unique=("customer_id",),
    ),
    "stg_product": Checks(
        not_null=("product_id", "product_name", "unit_price"),
        unique=("product_id",),
    ),
    "stg_orders": Checks(
        not_null=("order_id", "customer_id", "order_date", "order_status"),
        unique=("order_id",),
        relationships=(("customer_id", "stg_customer", "customer_id"),),
    ),
    "stg_order_line": Checks(
        not_null=("order_line_id", "order_id", "product_id", "quantity", "unit_price"),
        unique=("order_line_id",),
        relationships=(
            ("order_id", "stg_orders", "order_id"),
            ("product_id", "stg_product", "product_id"),
        ),
    ),
    "int_sales_enriched": Checks(
        not_null=(
            "order_line_id",
            "order_id",
            "customer_id",
            "product_id",
            "quantity",
            "gross_amount",
            "net_amount",
        ),
        unique=("order_line_id",),
    ),
    "dim_customer": Checks(
        not_null=("customer_key", "customer_id"),
        unique=("customer_key", "customer_id"),
    ),
    "dim_product": Checks(
        not_null=("product_key", "product_id", "product_name"),
        unique=("product_key", "product_id"),
    ),
    "dim_date": Checks(
        not_null=(
            "date_key",
            "order_date",
            "year",
            "month_number",
            "day_of_month",
            "month_name",
            "weekday_name",
        ),
        unique=("date_key", "order_date"),
    ),
    "fact_sales": Checks(
        not_null=(
            "customer_key",
            "product_key",
            "date_key",
            "order_line_id",
            "customer_id",
            "product_id",
            "order_id",
            "net_amount",
        ),
        unique=("order_line_id",),
        relationships=(
            ("customer_key", "dim_customer", "customer_key"),
            ("product_key", "dim_product", "product_key"),
            ("date_key", "dim_date", "date_key"),
            ("customer_id", "dim_customer", "customer_id"),
            ("product_id", "dim_product", "product_id"),
        ),
    ),
}
