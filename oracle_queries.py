"""DuckDB SQL each query of ``__spark_entry__`` must agree with, on whole tables.

Written from the definition of each result, not from the Spark plans. Percentages are taken as
``* 0.01``: DuckDB divides decimals in floating point, which goes wrong on half cents.
"""

from __future__ import annotations

from tidemill.contracts import CHECKS, FILE_NAME_PATTERN

LINES = """
lines_history AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_line_id,
         l_orderkey AS order_id,
         l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
         CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_pct,
         l_shipdate AS modified_at,
         l_suppkey AS supplier_id
  FROM lineitem)"""

ORDERS = """
cur_orders AS (
  SELECT o_orderkey AS order_id,
         o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         lower(trim(o_orderstatus)) AS order_status,
         upper(trim(o_orderpriority)) AS currency,
         o_orderdate AS modified_at
  FROM orders)"""

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_id,
         trim(c_name) AS first_name,
         trim(c_mktsegment) AS last_name,
         lower(c_name || '@' || c_mktsegment) AS email,
         CAST(c_nationkey AS VARCHAR) AS city,
         c_mktsegment AS customer_status
  FROM customer)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, trim(p_name) AS product_name, trim(p_type) AS category
  FROM part)"""


def latest(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_line_id
      ORDER BY modified_at DESC NULLS LAST, product_id DESC, supplier_id DESC) AS rn
    FROM {source}) WHERE rn = 1)"""


def sales(lines: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT o.order_id, o.order_date, o.order_status, o.currency, o.customer_id,
         c.first_name, c.last_name, c.email, c.city, c.customer_status,
         l.order_line_id, l.product_id, l.quantity, l.unit_price, l.discount_pct,
         p.product_name, p.category,
         CAST(l.quantity * l.unit_price AS DECIMAL(18,2)) AS gross_amount,
         CAST(l.quantity * l.unit_price * coalesce(l.discount_pct, 0) * 0.01
              AS DECIMAL(18,2)) AS discount_amount,
         CAST(l.quantity * l.unit_price * (1 - coalesce(l.discount_pct, 0) * 0.01)
              AS DECIMAL(18,2)) AS net_amount,
         o.modified_at AS order_modified_at,
         l.modified_at AS order_line_modified_at
  FROM {lines} l
  JOIN cur_orders o ON l.order_id = o.order_id
  JOIN customers c ON o.customer_id = c.customer_id
  JOIN products p ON l.product_id = p.product_id)"""


def fact(sales_name: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT s.order_line_id, s.order_id,
         CAST(year(s.order_date) * 10000 + month(s.order_date) * 100 + day(s.order_date)
              AS INTEGER) AS date_key,
         upper(sha256('customer|' || CAST(s.customer_id AS VARCHAR))) AS customer_key,
         upper(sha256('product|' || CAST(s.product_id AS VARCHAR))) AS product_key,
         s.customer_id, s.product_id, s.quantity, s.unit_price, s.discount_pct,
         s.gross_amount, s.discount_amount, s.net_amount, s.currency, s.order_status,
         s.order_modified_at, s.order_line_modified_at
  FROM {sales_name} s WHERE s.order_date IS NOT NULL)"""


BASE = f"WITH {LINES},{ORDERS},{CUSTOMERS},{PRODUCTS},"
FULL = BASE + ",".join([latest("lines_history", "cur_lines"), sales("cur_lines", "enriched")])


def incremental(cut: str) -> str:
    """The fact of the lines up to ``cut``, then the delta of what is newer than that fact."""
    parts = [
        f"""
older AS (SELECT * FROM lines_history WHERE modified_at <= TIMESTAMP '{cut}')""",
        latest("older", "old_lines"),
        sales("old_lines", "old_enriched"),
        fact("old_enriched", "target"),
        """
mark AS (
  SELECT coalesce(max(order_line_modified_at), TIMESTAMP '1900-01-01') AS watermark FROM target)""",
        latest("lines_history", "all_lines"),
        """
changed AS (
  SELECT * FROM all_lines WHERE modified_at > (SELECT watermark FROM mark))""",
        sales("changed", "changed_enriched"),
        fact("changed_enriched", "delta"),
    ]
    return BASE + ",".join(parts)


CUSTOMER_HISTORY = """
customer_history AS (
  SELECT c_custkey AS customer_id,
         '  ' || c_name || ' ' AS first_name,
         ' ' || c_mktsegment AS last_name,
         ' ' || c_name || '@' || c_mktsegment AS email,
         o_orderpriority AS city,
         o_orderstatus AS status,
         o_orderdate AS created_at,
         o_orderdate AS modified_at,
         row_number() OVER (
           PARTITION BY c_custkey
           ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey),
stg_customer AS (
  SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
         lower(trim(email)) AS email, city, status, created_at, modified_at
  FROM customer_history WHERE rn = 1)"""

PRODUCT_HISTORY = """
product_history AS (
  SELECT p_partkey AS product_id,
         ' ' || p_name || '  ' AS product_name,
         ' ' || p_type AS category,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
         l_linestatus = 'O' AS is_active,
         l_shipdate AS created_at,
         l_shipdate AS modified_at,
         row_number() OVER (
           PARTITION BY p_partkey
           ORDER BY l_shipdate DESC NULLS LAST, l_orderkey DESC NULLS LAST,
                    l_linenumber DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
  FROM part LEFT JOIN lineitem ON p_partkey = l_partkey),
stg_product AS (
  SELECT product_id, trim(product_name) AS product_name, trim(category) AS category,
         unit_price, is_active, created_at, modified_at
  FROM product_history WHERE rn = 1)"""

DIM_CUSTOMER = """
dim_customer AS (
  SELECT upper(sha256('customer|' || CAST(customer_id AS VARCHAR))) AS customer_key,
         customer_id, first_name, last_name, email, city, status AS customer_status,
         created_at, modified_at
  FROM stg_customer)"""

DIM_PRODUCT = """
dim_product AS (
  SELECT upper(sha256('product|' || CAST(product_id AS VARCHAR))) AS product_key,
         product_id, product_name, category, unit_price, is_active, created_at, modified_at
  FROM stg_product)"""

DIM_DATE = """
dim_date AS (
  SELECT CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date)
              AS INTEGER) AS date_key,
         order_date,
         CAST(year(order_date) AS INTEGER) AS year,
         CAST(month(order_date) AS INTEGER) AS month_number,
         CAST(day(order_date) AS INTEGER) AS day_of_month,
         monthname(order_date) AS month_name,
         dayname(order_date) AS weekday_name
  FROM (SELECT DISTINCT order_date FROM cur_orders))"""

EVENT_FILES = """
event_files AS (
  SELECT *, CAST(ts AS DATE) AS source_date,
         'web/' || event_type || '/' || strftime(ts, '%Y/%m/%d') || '/' || event_type || '_'
           || strftime(ts, '%Y%m%d') || '_incremental.parquet' AS source_file
  FROM events)"""

LEDGER = f"""{EVENT_FILES},
ledger AS (
  SELECT 'web' AS source_name, event_type AS table_name, source_file,
         CAST(source_date AS VARCHAR) AS source_date,
         min(ts) AS started_at, max(ts) AS loaded_at,
         CAST(count(*) FILTER (WHERE value >= 200) AS BIGINT) AS rows_ingested,
         CASE WHEN max(value) >= 300 THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM event_files GROUP BY event_type, source_date, source_file)"""


def null_count(relation: str, table: str, column: str) -> str:
    return (
        f"SELECT 'not_null' AS check_name, '{relation}' AS relation, '{column}' AS \"column\", "
        f"CAST(count(*) AS BIGINT) AS violations FROM {table} WHERE {column} IS NULL"
    )


def repeats(relation: str, table: str, column: str) -> str:
    return (
        f"SELECT 'unique' AS check_name, '{relation}' AS relation, '{column}' AS \"column\", "
        f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {column} FROM {table} "
        f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    )


def strays(relation: str, child: str, column: str, parent: str, parent_column: str) -> str:
    return (
        f"SELECT 'relationships' AS check_name, '{relation}' AS relation, "
        f"'{column}' AS \"column\", CAST(count(*) AS BIGINT) AS violations "
        f"FROM {child} c ANTI JOIN {parent} p ON c.{column} = p.{parent_column} "
        f"WHERE c.{column} IS NOT NULL"
    )


def report() -> str:
    relations = ",".join(
        [
            CUSTOMER_HISTORY,
            PRODUCT_HISTORY,
            LINES,
            latest("lines_history", "stg_order_line"),
            ORDERS,
            "stg_orders AS (SELECT * FROM cur_orders)",
            "customers AS (SELECT *, status AS customer_status FROM stg_customer)",
            "products AS (SELECT * FROM stg_product)",
            sales("stg_order_line", "int_sales_enriched"),
            DIM_CUSTOMER,
            DIM_PRODUCT,
            DIM_DATE,
            fact("int_sales_enriched", "fact_sales"),
        ]
    )
    checks = []
    for name, declared in CHECKS.items():
        checks += [null_count(name, name, c) for c in declared.not_null]
        checks += [repeats(name, name, c) for c in declared.unique]
        checks += [strays(name, name, c, p, pc) for c, p, pc in declared.relationships]
    return f"WITH {relations} " + " UNION ALL ".join(checks)


def oracle_sql(cut: str, tables: tuple[str, ...]) -> dict[str, str]:
    counts = [
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
        for t in tables
    ]
    counts.append("SELECT 'returns' AS table_name, CAST(NULL AS BIGINT) AS row_count")
    upserted = f"""{incremental(cut)}
SELECT t.* FROM target t ANTI JOIN delta d ON t.order_line_id = d.order_line_id
UNION ALL SELECT * FROM delta"""
    by_price = "quantity DESC, unit_price DESC, discount_pct DESC)"
    changed_orders = ORDERS.replace(
        "o_custkey AS", "CASE WHEN o_orderkey % 35 = 0 THEN -1 ELSE o_custkey END AS"
    ).replace(
        "lower(trim(o_orderstatus)) AS",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'returned' ELSE lower(trim(o_orderstatus)) END AS",
    )
    after_changes = ",".join(
        [
            f"WITH {LINES},{changed_orders},{CUSTOMERS},{PRODUCTS}",
            latest("lines_history", "cur_lines").replace("supplier_id DESC)", by_price),
            sales("cur_lines", "enriched"),
            fact("enriched", "whole"),
        ]
    )
    order_versions = """
            WITH history AS (
              SELECT l_orderkey AS order_id, ' ' || l_returnflag || ' ' AS flag,
                     l_partkey AS product_id, l_quantity AS quantity,
                     CAST(date_trunc('year', l_shipdate) AS TIMESTAMP) AS modified_at,
                     TIMESTAMP '2030-01-01' AS _ingested_at,
                     'erp/' || l_linestatus || '/' || l_linenumber AS _source_file
              FROM lineitem)
            SELECT order_id, lower(trim(flag)) AS flag, product_id, quantity, modified_at, _ingested_at
            FROM history
            QUALIFY row_number() OVER (
              PARTITION BY order_id
              ORDER BY modified_at DESC NULLS LAST, _source_file DESC NULLS LAST,
                       flag DESC NULLS LAST, product_id DESC NULLS LAST, quantity DESC NULLS LAST
            ) = 1"""
    return {
        "current_order_lines": f"WITH {LINES},{latest('lines_history', 'cur_lines')} "
        "SELECT * FROM cur_lines",
        "current_events_by_user": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
        "current_order_by_customer": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""",
        "clean_text": """
SELECT c_custkey, trim('  ' || c_name || chr(9) || ' ') AS trimmed,
       lower(trim(' ' || c_name || ' ')) AS lowered,
       upper(trim(' ' || lower(c_mktsegment) || '  ')) AS uppered
FROM customer""",
        "sales_enriched": FULL + " SELECT * FROM enriched",
        "dim_customer": f"WITH {CUSTOMER_HISTORY},{DIM_CUSTOMER} SELECT * FROM dim_customer",
        "dim_product": f"WITH {PRODUCT_HISTORY},{DIM_PRODUCT} SELECT * FROM dim_product",
        "dim_date": f"WITH {ORDERS},{DIM_DATE} SELECT * FROM dim_date",
        "fact_sales_full": FULL + "," + fact("enriched", "fact_sales") + " SELECT * FROM fact_sales",
        "fact_sales_direct": FULL
        + ","
        + fact("enriched", "fact_sales")
        + " SELECT * FROM fact_sales",
        "fact_watermark": incremental(cut) + " SELECT watermark FROM mark",
        "fact_sales_watermark_delta": incremental(cut) + " SELECT * FROM delta",
        "fact_sales_upsert": upserted,
        "fact_sales_publish": upserted,
        "dq_not_null": "WITH nulled AS (SELECT l_orderkey, nullif(l_returnflag, 'N') AS "
        "l_returnflag, nullif(l_linenumber, 7) AS l_linenumber, l_shipdate FROM lineitem) "
        + " UNION ALL ".join(
            null_count("lineitem", "nulled", c)
            for c in ("l_orderkey", "l_returnflag", "l_linenumber", "l_shipdate")
        ),
        "dq_unique": f"WITH {LINES} "
        + " UNION ALL ".join(
            [
                repeats("order_line", "lines_history", "order_line_id"),
                repeats("orders", "orders", "o_custkey"),
                repeats("events", "events", "user_id"),
                repeats("orders", "orders", "o_orderkey"),
            ]
        ),
        "dq_relationships": " UNION ALL ".join(
            [
                strays("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"),
                strays("orders", "orders", "o_custkey", "customer", "c_custkey"),
                strays("lineitem", "lineitem", "l_partkey", "supplier", "s_suppkey"),
                strays("orders", "orders", "o_orderkey", "customer", "c_custkey"),
            ]
        ),
        "dq_orphans": """
SELECT l_partkey, CAST(count(*) AS BIGINT) AS rows
FROM lineitem ANTI JOIN supplier ON l_partkey = s_suppkey
WHERE l_partkey IS NOT NULL GROUP BY l_partkey""",
        "dq_report": report(),
        "dq_in_batches": " UNION ALL ".join(
            [
                null_count("lineitem", "(SELECT nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem)", "l_returnflag"),
                null_count("lineitem", "lineitem", "l_shipdate"),
                repeats("lineitem", "lineitem", "l_orderkey"),
                repeats("lineitem", "lineitem", "l_shipdate"),
                strays("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"),
                strays("lineitem", "lineitem", "l_partkey", "supplier", "s_suppkey"),
                null_count("orders", "orders", "o_orderkey"),
                repeats("orders", "orders", "o_orderkey"),
                repeats("orders", "orders", "o_custkey"),
                strays("orders", "orders", "o_custkey", "customer", "c_custkey"),
                repeats("customer", "customer", "c_custkey"),
                repeats("customer", "customer", "c_name"),
            ]
        ),
        "manifest_parse": f"""
WITH named AS (
  SELECT event_id,
         CASE WHEN value BETWEEN 5 AND 6 THEN 'orders' ELSE upper(event_type) END AS table_name,
         event_type || '_'
           || CASE WHEN value >= 60 THEN '20261399' ELSE strftime(ts, '%Y%m%d') END || '_'
           || CASE WHEN value < 1 THEN 'delta' WHEN value < 10 THEN 'FULL' ELSE 'incremental' END
           || '.parquet' AS file_name
  FROM events),
parsed AS (
  SELECT *,
         regexp_extract(file_name, '{FILE_NAME_PATTERN}', 1) AS named_table,
         CAST(try_strptime(regexp_extract(file_name, '{FILE_NAME_PATTERN}', 2), '%Y%m%d')
              AS DATE) AS source_date,
         nullif(lower(regexp_extract(file_name, '{FILE_NAME_PATTERN}', 3)), '') AS load_type
  FROM named),
judged AS (
  SELECT *, CASE WHEN named_table = '' THEN 'file name does not follow the convention'
                 WHEN lower(named_table) <> lower(table_name) THEN 'file is of another table'
                 WHEN source_date IS NULL THEN 'file date is not a date' END AS reject_reason
  FROM parsed)
SELECT event_id, file_name, table_name, source_date, load_type, reject_reason,
       CASE WHEN reject_reason IS NULL THEN 'web/' || table_name || '/'
         || strftime(source_date, '%Y/%m/%d') || '/' || file_name END AS source_file
FROM judged""",
        "pending_files": f"""WITH {LEDGER}
SELECT DISTINCT source_file, source_date FROM event_files
WHERE source_file NOT IN (SELECT source_file FROM ledger WHERE status = 'SUCCESS')""",
        "rows_per_file": f"""WITH {EVENT_FILES}
SELECT source_file, CAST(count(*) FILTER (WHERE value >= 200) AS BIGINT) AS rows_ingested
FROM event_files GROUP BY source_file""",
        "load_summary": f"""WITH {LEDGER}
SELECT CAST(count(*) AS BIGINT) AS processed,
       CAST(count(*) FILTER (WHERE status = 'SUCCESS') AS BIGINT) AS successful,
       CAST(count(*) FILTER (WHERE status = 'FAILED') AS BIGINT) AS failed
FROM ledger""",
        "ingest_anomalies": f"""WITH {LEDGER}
SELECT * FROM ledger WHERE status <> 'SUCCESS' OR rows_ingested = 0
ORDER BY started_at DESC""",
        "ledger_report": f"""WITH {LEDGER}
SELECT * FROM ledger ORDER BY started_at DESC, source_name, table_name""",
        "key_history": """
SELECT * FROM events WHERE user_id = (
  SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
ORDER BY ts""",
        "key_history_by_files": """
SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00' AND user_id = (
  SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
ORDER BY ts""",
        "table_counts": " UNION ALL ".join(counts),
        "archive_partitions": """
SELECT 'events_' || strftime(ts, '%Y%m%d') || '_incremental.parquet' AS file_name,
       CAST(count(*) AS BIGINT) AS rows_landed, CAST(count(*) AS BIGINT) AS rows_archived,
       true AS complete
FROM events GROUP BY 1""",
        "ingest_roundtrip": """
SELECT 'web/events/' || strftime(ts, '%Y/%m/%d') || '/events_' || strftime(ts, '%Y%m%d')
         || '_incremental.parquet' AS source_file,
       'first' AS batch, CAST(count(*) AS BIGINT) AS rows_held,
       CAST(ts AS DATE) AS source_date, 'incremental' AS load_type,
       CAST(count(*) AS BIGINT) AS rows_ingested, 'SUCCESS' AS status
FROM events GROUP BY ALL""",
        "ingest_with_drift": """
            WITH files AS (
              SELECT 'web/events/' || strftime(ts, '%Y/%m/%d') || '/events_' || strftime(ts, '%Y%m%d')
                       || '_incremental.parquet' AS source_file,
                     day(ts) % 2 = 1 AS odd, count(*) AS n
              FROM events GROUP BY ALL)
            SELECT source_file, 'strict' AS batch, 'FAILED' AS status,
                   CAST(NULL AS BIGINT) AS rows_ingested, CAST(NULL AS BIGINT) AS with_channel,
                   true AS refused
            FROM files WHERE odd
            UNION ALL
            SELECT source_file, CASE WHEN odd THEN 'lenient' ELSE 'strict' END, 'SUCCESS', n,
                   CASE WHEN odd THEN n ELSE 0 END, NULL
            FROM files""",
        "ingest_with_widening": """
            WITH files AS (
              SELECT 'web/events/' || strftime(ts, '%Y/%m/%d') || '/events_' || strftime(ts, '%Y%m%d')
                       || '_incremental.parquet' AS source_file,
                     day(ts) % 4 AS kind, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users,
                     CAST(sum(user_id % 100) AS BIGINT) AS weight,
                     count(*) FILTER (ts = date_trunc('day', ts)) AS at_midnight
              FROM events GROUP BY ALL)
            SELECT source_file, CASE WHEN kind = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                   CASE WHEN kind < 3 THEN n END AS rows_ingested,
                   CASE WHEN kind < 3 THEN users END AS user_ids,
                   CASE kind WHEN 1 THEN 4 * weight WHEN 2 THEN weight END AS weights,
                   CASE WHEN kind = 1 THEN n WHEN kind < 3 THEN at_midnight END AS midnights,
                   CASE WHEN kind = 3 THEN true END AS refused
            FROM files""",
        "current_state_files": order_versions,
        "current_state_in_steps": order_versions,
        "archive_landing": """
            WITH files AS (
              SELECT CAST(ts AS DATE) AS source_date, 'incremental' AS load_type, count(*) AS n
              FROM events GROUP BY ALL
              UNION ALL VALUES (DATE '1900-01-01', 'full', NULL), (DATE '1900-01-02', 'full', NULL))
            SELECT b.batch, 'events_' || strftime(source_date, '%Y%m%d') || '_' || load_type
                     || '.parquet' AS file_name,
                   source_date, load_type,
                   CASE WHEN n IS NULL OR (batch = 'second' AND day(source_date) % 2 = 1)
                        THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                   CASE WHEN batch = 'first' OR day(source_date) % 2 = 0 THEN n END AS rows_archived,
                   n IS NOT NULL AND batch = 'second' AND day(source_date) % 2 = 1 AS conflict
            FROM files, (VALUES ('first'), ('second')) b(batch)""",
        "star_in_two_builds": upserted.replace("supplier_id DESC)", by_price),
        "star_after_order_changes": after_changes + " SELECT * FROM whole",
        "watermark_default": """
            SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') AS watermark
            FROM events WHERE value < 0""",
        "amounts_without_discount": """
            WITH lines AS (
              SELECT l_orderkey * 10 + l_linenumber AS order_line_id, l_partkey AS product_id,
                     l_suppkey AS supplier_id, CAST(l_quantity AS INTEGER) AS quantity,
                     CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
                     CAST(l_discount * 100 AS DECIMAL(5,2)) AS share
              FROM lineitem)
            SELECT order_line_id, product_id, supplier_id,
                   CAST(quantity * price AS DECIMAL(18,2)) AS gross_amount,
                   CAST(quantity * price * share * 0.01 AS DECIMAL(18,2)) AS discount_amount,
                   CAST(quantity * price * (1 - share * 0.01) AS DECIMAL(18,2)) AS net_amount
            FROM lines""",
        "failed_ledger_rows": """
            SELECT 'web/' || event_type || '/' || strftime(ts, '%Y/%m/%d') || '/' || event_type || '_'
                     || strftime(ts, '%Y%m%d') || '_incremental.parquet' AS source_file,
                   strftime(ts, '%Y-%m-%d') AS source_date, 'FAILED' AS status,
                   CAST(NULL AS BIGINT) AS rows_ingested,
                   left(string_agg(repeat(CAST(event_id AS VARCHAR), 400), ',' ORDER BY event_id),
                        4000) AS error_message
            FROM events GROUP BY event_type, strftime(ts, '%Y/%m/%d'), strftime(ts, '%Y%m%d'),
                                 strftime(ts, '%Y-%m-%d')""",
    }
