"""Archive and ingest when things go wrong."""

from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tests.retail import at, customer, land_file, ticking
from tidemill.contracts import CUSTOMER
from tidemill.operators.ledger import ingest_anomalies, pending_files
from tidemill.plans import archive as archive_module
from tidemill.plans import ingest as ingest_module
from tidemill.plans.archive import ArchiveFailed, archive_all
from tidemill.plans.ingest import archived_files, ingest_new_files
from tidemill.sources.files import SchemaDrift
from tidemill.sources.tables import Lakehouse, committed_history, prepare


class Loader:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.landing, self.archive = f"{root}/landing", f"{root}/archive"
        self.lake = Lakehouse(location=f"{root}/tables", prefix=f"t_{uuid4().hex}")
        self.clock = ticking(at(23))
        prepare(spark, self.lake, (CUSTOMER,))

    def land(self, name, rows, schema=None):
        return land_file(self.spark, self.landing, CUSTOMER, name, rows, schema)

    def store(self, batch, recursive=False):
        return archive_all(
            self.spark,
            self.lake,
            self.landing,
            self.archive,
            (CUSTOMER,),
            batch,
            self.clock(),
            recursive,
        ).first()

    def ingest(self, batch, **options):
        return ingest_new_files(
            self.spark, self.lake, self.archive, CUSTOMER, batch, clock=self.clock, **options
        )

    def messages(self, batch):
        log = self.spark.table(self.lake.archive_log).where(F.col("batch_id") == batch)
        return {r.file_name: (r.status, r.message, r.rows_archived) for r in log.collect()}

    def ledger(self):
        return self.spark.table(self.lake.ledger)

    def history(self):
        return committed_history(self.spark, self.lake, CUSTOMER)


@pytest.fixture
def loader(spark, tmp_path):
    return Loader(spark, tmp_path)


GOOD = "customer_20260801_full.parquet"


def test_archive_goes_on_past_bad_files_then_fails(loader):
    loader.land(GOOD, [customer(n, at(1)) for n in range(5)])
    loader.land("customer_20260802_incremental.parquet", [])
    loader.land("product_20260801_full.parquet", [customer(9, at(1))])
    bad = loader.land("customer_2026_full.parquet", [])
    bad.write_bytes(b"not parquet at all")
    with pytest.raises(ArchiveFailed, match="2 file"):
        loader.store("first")
    got = loader.messages("first")
    assert got[GOOD] == ("SUCCESS", "archived, row counts agree", 5)
    assert got["customer_20260802_incremental.parquet"][::2] == ("SUCCESS", 0)
    assert got["product_20260801_full.parquet"][0] == "FAILED"
    assert got["customer_2026_full.parquet"][:2] == (
        "FAILED",
        "file name does not follow the convention",
    )
    # the good ones load, the empty one shows up as an anomaly
    assert loader.ingest("first") == 2
    assert loader.history().count() == 5
    odd = ingest_anomalies(loader.ledger()).collect()
    assert [(r.status, r.rows_ingested) for r in odd] == [("SUCCESS", 0)]
    assert loader.ingest("second") == 0


def test_changed_file_is_refused_and_the_archive_kept(loader):
    loader.land(GOOD, [customer(1, at(1))])
    assert tuple(loader.store("first")) == (1, 1, 0)
    loader.land(GOOD, [customer(n, at(1), city="Elsewhere") for n in range(50)])
    with pytest.raises(ArchiveFailed):
        loader.store("second")
    assert loader.messages("second")[GOOD][:2] == (
        "FAILED",
        "already archived with another size",
    )
    assert loader.ingest("first") == 1
    assert [r.city for r in loader.history().collect()] == ["Porto"]


def test_archive_keeps_columns_it_does_not_know(loader):
    wide = StructType([*CUSTOMER.schema.fields, StructField("extra", StringType())])
    loader.land(GOOD, [customer(1, at(1))])
    loader.land(
        "customer_20260802_incremental.parquet", [(*customer(2, at(2)), "kept")], wide
    )
    loader.store("first")
    with pytest.raises(SchemaDrift, match="unexpected column extra"):
        loader.ingest("strict")
    # the plain file is in, the wide one is refused and stays pending
    states = {r.status: r for r in loader.ledger().collect()}
    assert (states["SUCCESS"].rows_ingested, states["FAILED"].rows_ingested) == (1, None)
    assert "unexpected column extra" in states["FAILED"].error_message
    assert [r.customer_id for r in loader.history().collect()] == [1]
    # with evolution allowed it loads, and older rows read null
    assert loader.ingest("lenient", allow_new_columns=True) == 1
    rows = {r.customer_id: r.extra for r in loader.history().collect()}
    assert rows == {1: None, 2: "kept"}
    # a late plain file of the wide one's day is not held against it
    loader.land("customer_20260802_full.parquet", [customer(3, at(2))])
    loader.store("second")
    assert loader.ingest("third") == 1
    assert loader.history().count() == 3


def test_a_missing_column_is_refused_in_any_company(loader):
    narrow = StructType([f for f in CUSTOMER.schema.fields if f.name != "city"])
    row = customer(1, at(1))
    loader.land(GOOD, [row[:4] + row[5:]], narrow)
    loader.land("customer_20260801_incremental.parquet", [customer(2, at(1))])
    loader.store("first")
    with pytest.raises(SchemaDrift, match="missing column city"):
        loader.ingest("first", allow_new_columns=True)
    assert [r.customer_id for r in loader.history().collect()] == [2]


def test_corrupt_and_retyped_files_fail_alone(loader):
    loader.land(GOOD, [customer(n, at(1)) for n in range(3)])
    loader.land("customer_20260802_full.parquet", []).write_bytes(b"PAR1 not a parquet file PAR1")
    loader.land("customer_20260803_full.parquet", []).write_bytes(b"")
    retyped = StructType(
        [StructField("city", DateType()) if f.name == "city" else f for f in CUSTOMER.schema]
    )
    row = customer(9, at(4))
    loader.land("customer_20260804_full.parquet", [row[:4] + (None,) + row[5:]], retyped)
    with pytest.raises(ArchiveFailed, match="2 file"):
        loader.store("first")
    got = loader.messages("first")
    assert got[GOOD] == ("SUCCESS", "archived, row counts agree", 3)
    assert got["customer_20260802_full.parquet"][0] == "FAILED"
    assert "cannot be read" in got["customer_20260802_full.parquet"][1]
    assert got["customer_20260803_full.parquet"][:2] == ("FAILED", "file has no bytes")
    assert got["customer_20260804_full.parquet"][::2] == ("SUCCESS", 1)
    with pytest.raises(SchemaDrift, match="column city is date"):
        loader.ingest("first")
    assert loader.history().count() == 3


@pytest.mark.parametrize("when", ["before its footer", "before its rows"])
def test_a_file_that_goes_away_fails_and_may_return(loader, monkeypatch, when):
    loader.land(GOOD, [customer(n, at(1)) for n in range(3)])
    rows = [customer(n, at(2)) for n in range(10, 15)]
    second = loader.land("customer_20260802_full.parquet", rows)

    def without_it(function, late):
        def run(*args):
            out = function(*args) if late else None
            second.unlink(missing_ok=True)
            return out if late else function(*args)

        return run

    with monkeypatch.context() as patch:
        late = when == "before its rows"
        patch.setattr(archive_module, "footers", without_it(archive_module.footers, late))
        with pytest.raises(ArchiveFailed, match="1 file"):
            loader.store("first")
    got = loader.messages("first")
    assert got[GOOD] == ("SUCCESS", "archived, row counts agree", 3)
    assert got[second.name][0] == "FAILED" and got[second.name][2] is None
    loader.land(second.name, rows)
    loader.store("second")
    assert loader.messages("second")[second.name] == ("SUCCESS", "archived, row counts agree", 5)
    assert loader.ingest("all") == 2
    assert loader.history().count() == 8


def test_missing_and_retyped_columns_are_refused(loader):
    narrow = StructType([f for f in CUSTOMER.schema.fields if f.name != "city"])
    row = customer(1, at(1))
    loader.land(GOOD, [row[:4] + row[5:]], narrow)
    loader.store("first")
    with pytest.raises(SchemaDrift, match="missing column city"):
        loader.ingest("first", allow_new_columns=True)


@pytest.mark.parametrize("retry, left_over", [("lost", 4), ("retry", 8)])
def test_crash_between_data_and_ledger_loads_once(loader, monkeypatch, retry, left_over):
    loader.land(GOOD, [customer(n, at(1)) for n in range(4)])
    loader.store("first")

    def die(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(ingest_module, "append", die)
        with pytest.raises(KeyboardInterrupt):
            loader.ingest("lost")
    table = loader.lake.history(CUSTOMER)
    assert loader.spark.table(table).count() == 4 and loader.history().isEmpty()
    assert loader.ingest(retry) == 1
    assert loader.spark.table(table).count() == left_over
    assert loader.history().count() == 4


def test_a_loaded_batch_id_is_not_used_again(loader):
    loader.land(GOOD, [customer(1, at(1))])
    loader.store("first")
    assert loader.ingest("it's") == 1
    assert loader.ingest("it's") == 0
    loader.land("customer_20260802_full.parquet", [customer(2, at(2))])
    loader.store("second")
    with pytest.raises(ValueError, match="take a new id"):
        loader.ingest("it's")
    assert [r.customer_id for r in loader.history().collect()] == [1]
    assert loader.ingest("other") == 1


def test_late_file_of_an_earlier_day_is_picked_up(loader):
    loader.land("customer_20260805_full.parquet", [customer(1, at(5))])
    loader.store("first")
    assert loader.ingest("first") == 1
    loader.land(GOOD, [customer(1, at(1)), customer(2, at(1))])
    loader.land("customer_20260805_incremental.parquet", [customer(3, at(5))])
    loader.store("second")
    files = archived_files(loader.spark, loader.lake, CUSTOMER)
    assert pending_files(files, loader.ledger()).count() == 2
    assert loader.ingest("second") == 2
    rows = loader.history().groupBy("_batch_id").count().collect()
    assert {r._batch_id: r["count"] for r in rows} == {"first": 1, "second": 3}


def test_an_existing_dated_tree_is_taken_over(loader):
    for day, number in ((1, 10), (2, 20)):
        name = f"2026/08/0{day}/customer_2026080{day}_full.parquet"
        (loader.root / f"landing/crm/customer/2026/08/0{day}").mkdir(parents=True)
        loader.land(name, [customer(n, at(day)) for n in range(number)])
    assert tuple(loader.store("flat")) == (0, 0, 0)
    assert tuple(loader.store("tree", recursive=True)) == (2, 2, 0)
    assert loader.ingest("tree") == 2
    assert loader.history().count() == 30
    files = {r[0] for r in loader.history().select("_source_file").distinct().collect()}
    assert files == {
        "crm/customer/2026/08/01/customer_20260801_full.parquet",
        "crm/customer/2026/08/02/customer_20260802_full.parquet",
    }
    (loader.root / "landing/crm/customer/copy").mkdir()
    loader.land("copy/customer_20260802_full.parquet", [customer(1, at(2))])
    with pytest.raises(ArchiveFailed, match="2 file"):
        loader.store("twins", recursive=True)
