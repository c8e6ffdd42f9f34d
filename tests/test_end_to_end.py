"""Land, archive, ingest and build four batches; DuckDB derives the expected rows from the fixture."""

import hashlib
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path
from uuid import uuid4

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.retail import BATCHES, CORRECTED, at, land, land_file, line, ticking
from tidemill.contracts import CHECKS, CUSTOMER, ENTITIES, ORDER_LINE, ORDERS
from tidemill.operators.history import key_history, table_counts
from tidemill.operators.ledger import ingest_anomalies, ledger_report
from tidemill.operators.quality import run_checks
from tidemill.plans import build as build_module
from tidemill.plans.archive import archive_all
from tidemill.plans.build import Mart, build_star, line_relations, register_views
from tidemill.plans.ingest import ingest_all
from tidemill.session import work_dir, written
from tidemill.sources.tables import Lakehouse, committed_history, prepare

LAST = list(BATCHES)[-1]


def expected(landing, batches) -> dict:
    """What must be there after the batches, from the landed files themselves. A line is in the fact
    as of the batch that brought its newest version."""
    sql = duckdb.connect()
    for entity in ENTITIES:
        files = [f"{landing}/{entity.source}/{entity.table}/{entity.table}_{b}.parquet" for b in batches]
        files = [f for f in files if Path(f).exists()]
        sql.execute(f"CREATE VIEW h_{entity.table} AS SELECT * FROM read_parquet({files})")
        sql.execute(
            f"CREATE VIEW c_{entity.table} AS SELECT * FROM h_{entity.table} "
            f"QUALIFY row_number() OVER (PARTITION BY {entity.key} ORDER BY modified_at DESC) = 1"
        )
    tables = [e.table for e in ENTITIES]
    one = lambda query: sql.execute(query).fetchone()
    fact = """FROM c_order_line l JOIN c_orders o USING (order_id)
              JOIN c_customer USING (customer_id) JOIN c_product USING (product_id)"""
    exact = "CAST(round({}, 2) AS DECIMAL(18, 2))"
    gross = "CAST(l.quantity * l.unit_price AS DECIMAL(28, 8))"
    part = f"{gross} * CAST(l.discount_pct AS DECIMAL(9, 4))"
    amounts = [
        exact.format(gross),
        exact.format(f"CAST({part} AS DECIMAL(38, 8)) / 100"),
        exact.format(f"{gross} - CAST({part} AS DECIMAL(38, 8)) / 100"),
    ]
    lines = sql.execute(f"SELECT l.order_line_id, {', '.join(amounts)} {fact}").fetchall()
    return {
        "history": tuple(one(f"SELECT count(*) FROM h_{t}")[0] for t in tables),
        "current": tuple(one(f"SELECT count(*) FROM c_{t}")[0] for t in tables),
        "amounts": {r[0]: tuple(Decimal(str(x)) for x in r[1:]) for r in lines},
        "newest": one(f"SELECT CAST(max(l.modified_at) AT TIME ZONE 'UTC' AS TIMESTAMP) {fact}")[0],
        "dates": one("SELECT count(DISTINCT order_date) FROM c_orders")[0],
        "status": dict(sql.execute("SELECT order_id, lower(trim(order_status)) FROM c_orders").fetchall()),
    }


class World:
    def __init__(self, spark, root):
        self.spark = spark
        self.landing, self.archive = f"{root}/landing", f"{root}/archive"
        self.lake = Lakehouse(location=f"{root}/tables", prefix=f"t_{uuid4().hex}")
        self.mart = Mart(f"{root}/gold", range_width=10)
        self.clock = ticking(at(27))
        prepare(spark, self.lake, ENTITIES)

    def run(self, batch_id, full_refresh=False):
        archive_all(
            self.spark, self.lake, self.landing, self.archive, ENTITIES, batch_id, self.clock()
        )
        loaded = ingest_all(
            self.spark, self.lake, self.archive, ENTITIES, batch_id, clock=self.clock
        )
        build = build_star(self.spark, self.lake, self.mart, full_refresh)
        work = work_dir(self.spark)
        lines = line_relations(self.spark, self.lake, build)
        lines = {name: written(df, f"{work}/{name}") for name, df in lines.items()}
        return loaded, {**build.relations, **lines}

    def history(self, entity):
        return committed_history(self.spark, self.lake, entity)

    def fact(self):
        return self.mart.read(self.spark, "fact_sales")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    world = World(spark, tmp_path_factory.mktemp("retail"))
    world.states = {}
    for batch in BATCHES:
        land(spark, world.landing, batch)
        loaded, relations = world.run(batch)
        histories = {e.table: world.history(e) for e in ENTITIES}
        counts = table_counts(
            spark,
            {
                **{f"h_{k}": v for k, v in histories.items()},
                **{k: v for k, v in relations.items()},
            },
        )
        fact = world.fact()
        world.states[batch] = {
            "loaded": loaded,
            "counts": {r.table_name: r.row_count for r in counts.collect()},
            "fact": {r.order_line_id: r for r in fact.collect()},
            "dates": relations["dim_date"].count(),
        }
    world.report = run_checks(relations, CHECKS).collect()
    return world


@pytest.mark.parametrize("batch", BATCHES)
def test_state_after_each_batch(world, batch):
    so_far = list(BATCHES)[: list(BATCHES).index(batch) + 1]
    want, state = expected(world.landing, so_far), world.states[batch]
    tables = [e.table for e in ENTITIES]
    assert tuple(state["counts"][f"h_{t}"] for t in tables) == want["history"]
    assert tuple(state["counts"][f"stg_{t}"] for t in tables) == want["current"]
    got = {k: (r.gross_amount, r.discount_amount, r.net_amount) for k, r in state["fact"].items()}
    assert got == want["amounts"]
    assert max(r.order_line_modified_at for r in state["fact"].values()) == want["newest"]
    assert state["dates"] == want["dates"]


def test_declared_checks(world):
    assert len(world.report) == 62
    assert {r.violations for r in world.report} == {0}


def test_files_per_batch(world):
    per_batch = [sum(world.states[b]["loaded"].values()) for b in BATCHES]
    assert per_batch == [len(files) for files in BATCHES.values()] == [4, 4, 3, 4]


def test_incremental_fact_rows(world):
    before, after = (world.states[b]["fact"] for b in list(BATCHES)[-2:])
    changed = {k for k in after if after[k] != before.get(k)}
    delivered = {row[0] for entity, rows in BATCHES[LAST] if entity is ORDER_LINE for row in rows}
    assert changed == delivered and CORRECTED in changed and CORRECTED in before
    assert (after[CORRECTED].quantity, after[CORRECTED].product_id) == (7, 990)
    assert after[CORRECTED].net_amount == Decimal("132.93")  # 7 x 19.99 less 5 percent


def test_order_change_alone_waits_for_a_full_refresh(world):
    old = [r for r in world.states[LAST]["fact"].values() if r.order_id == 4004]
    assert {r.order_status for r in old} == {"paid"}
    _, relations = world.run("refresh", full_refresh=True)
    refreshed = relations["fact_sales"].collect()
    want = expected(world.landing, BATCHES)
    assert {r.order_id: r.order_status for r in refreshed}[4004] == "returned"
    assert all(r.order_status == want["status"][r.order_id] for r in refreshed)
    got = {r.order_line_id: (r.gross_amount, r.discount_amount, r.net_amount) for r in refreshed}
    assert got == want["amounts"]


def test_rerun_is_a_no_op(world):
    ledger_before = world.spark.table(world.lake.ledger).count()
    rows_before = [world.history(e).count() for e in ENTITIES]
    fact_before = sorted(world.fact().collect())
    loaded, _ = world.run("again")
    assert set(loaded.values()) == {0}
    assert world.spark.table(world.lake.ledger).count() == ledger_before
    assert [world.history(e).count() for e in ENTITIES] == rows_before
    assert sorted(world.fact().collect()) == fact_before
    again = world.spark.table(world.lake.archive_log).where("batch_id = 'again'").collect()
    assert len(again) == 15
    assert {r.message for r in again} == {"already archived, same size"}


def test_key_histories(world):
    versions = key_history(world.history(CUSTOMER), "customer_id", 7003).collect()
    assert [(v.city, v.status) for v in versions] == [
        ("Cork", "active"),
        ("Bergen", "active"),
        ("Bergen", "closed"),
    ]
    assert [v._source_date for v in versions] == [date(2031, 3, d) for d in (3, 10, 17)]
    assert [v._load_type for v in versions] == ["full", "incremental", "incremental"]
    versions = key_history(world.history(ORDERS), "order_id", 4004).collect()
    assert [v.order_status for v in versions] == [" Paid", "Returned"]
    assert versions[1].modified_at == datetime(2031, 3, 17, 5)


def test_dimensions(world):
    def key(kind, number):
        return hashlib.sha256(f"{kind}|{number}".encode()).hexdigest().upper()

    customers = {r.customer_id: r for r in world.mart.read(world.spark, "dim_customer").collect()}
    row = customers[7003]
    assert (row.first_name, row.last_name, row.email) == ("Given7003", "Family7003", "buyer7003@shop.test")
    assert row.customer_status == "closed"
    products = {r.product_id: r for r in world.mart.read(world.spark, "dim_product").collect()}
    assert (products[990].product_name, products[990].category) == ("Ware 990", "Goods")
    assert row.customer_key == key("customer", 7003)
    assert products[990].product_key == key("product", 990)
    dates = {r.date_key: r for r in world.mart.read(world.spark, "dim_date").collect()}
    day = dates[20310317]
    assert (day.order_date, day.year, day.month_number, day.day_of_month) == (
        date(2031, 3, 17), 2031, 3, 17,
    )
    assert (day.month_name, day.weekday_name) == ("March", "Monday")
    loner = 7040
    assert loner in customers and all(r.customer_id != loner for r in world.fact().collect())


def test_reports(world):
    ledger = world.spark.table(world.lake.ledger)
    assert ingest_anomalies(ledger).count() == 0
    report = ledger_report(ledger).collect()
    assert len(report) == 15
    assert [r.started_at for r in report] == sorted((r.started_at for r in report), reverse=True)
    assert {r.source_file.count("/") for r in report} == {5}
    loads = [r.loaded_at for r in ledger_report(ledger, newest_first=False).collect()]
    assert loads == sorted(loads)
    rows = ledger.agg(F.sum("rows_ingested")).first()[0]
    assert rows == sum(len(rows) for files in BATCHES.values() for _, rows in files)


def test_the_newest_line_is_noted_and_the_fact_not_read_for_it(world):
    spark, mart = world.spark, world.mart
    path = mart.note(spark, build_module.CURRENT)
    newest = world.fact().agg(F.max("order_line_modified_at").cast("string")).first()[0]
    assert build_module.noted_newest(spark, mart, path) == newest
    assert build_module.noted_newest(spark, mart, "elsewhere") is None
    lines = world.history(ORDER_LINE)
    changed = build_module.changed_lines(lines, mart, path)
    assert changed.isEmpty()
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "fact_sales" not in plan and "GreaterThan(modified_at" in plan


def test_relations_answer_sql(world):
    register_views({t: world.mart.read(world.spark, t) for t in ("fact_sales", "dim_customer")})
    sold = world.spark.sql(
        "SELECT city, sum(net_amount) AS net FROM fact_sales JOIN dim_customer USING (customer_key) "
        "WHERE customer_status = 'closed' GROUP BY city"
    )
    assert {r.city for r in sold.collect()} <= {"Bergen"}


def test_interrupted_publication_is_completed(world, monkeypatch):
    """Last in this file, as it adds a line version."""
    before = world.fact().collect()
    row = line(70, 4001, 900, 2, "3.50", "0", at(26, 12))
    land_file(
        world.spark, world.landing, ORDER_LINE, "order_line_20310326_incremental.parquet", [row]
    )

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(build_module, "publish_staged", die)
        with pytest.raises(KeyboardInterrupt):
            world.run("cut short")
    # as if the run had died after removing the partition of lines 70 to 79
    folder = Path(world.mart.note(world.spark, build_module.CURRENT), "line_range=7")
    for file in folder.iterdir():
        file.unlink()
    assert world.fact().count() == len(before) - 10
    world.run("afterwards")
    after = {r.order_line_id: r for r in world.fact().collect()}
    assert len(after) == len(before)
    assert (after[70].quantity, after[70].net_amount) == (2, Decimal("7.00"))
    assert all(after[r.order_line_id] == r for r in before if r.order_line_id != 70)
    assert world.mart.note(world.spark, build_module.STAGED) is None
