"""Re-delivered files by their content, and footers read by tasks."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.retail import at, customer
from tests.test_loading import GOOD, Loader
from tidemill.operators.digest import content_digest
from tidemill.plans.archive import ArchiveFailed
from tidemill.sources.files import file_schemas


@pytest.fixture
def loader(spark, tmp_path):
    return Loader(spark, tmp_path)


def later(file):
    os.utime(file, (file.stat().st_atime, file.stat().st_mtime + 60))


def test_content_tells_files_of_one_size_apart(loader):
    rows = [customer(n, at(1)) for n in range(5)]
    size = loader.land(GOOD, rows).stat().st_size
    loader.store("first")
    other = loader.land(GOOD, [customer(n, at(1), city="Turku") for n in range(5)])
    assert other.stat().st_size == size
    later(other)
    with pytest.raises(ArchiveFailed, match="1 file"):
        loader.store("second")
    assert loader.messages("second")[GOOD] == ("FAILED", "already archived with other content", None)
    turned = loader.land(GOOD, rows[::-1])
    assert turned.stat().st_size == size
    later(later_file := turned)
    loader.store("third")
    assert loader.messages("third")[GOOD] == ("SUCCESS", "already archived, same content", 5)
    loader.store("fourth")  # not changed since, so not read again
    assert loader.messages("fourth")[GOOD] == ("SUCCESS", "already archived, same size", 5)
    later_file.write_bytes(b"x" * size)
    later(later_file)
    with pytest.raises(ArchiveFailed):
        loader.store("fifth")
    status, message, _ = loader.messages("fifth")[GOOD]
    assert status == "FAILED" and "cannot be read" in message
    assert loader.ingest("all") == 1 and loader.history().count() == 5


def digest(df):
    return content_digest(df.withColumn("g", F.lit(1)), ["g"]).first().content_digest


def test_digests_do_not_depend_on_order_but_on_all_else(spark):
    schema = "a int, b int, m map<string, int>"
    rows = [(1, None, {"x": 1, "y": 2}), (None, 1, None), (None, 1, None), (3, 4, {})]
    own = digest(spark.createDataFrame(rows, schema))
    assert digest(spark.createDataFrame(rows[::-1], schema).repartition(3)) == own
    assert digest(spark.createDataFrame(rows, schema).select("m", "b", "a")) == own
    turned = [(a, b, dict(reversed(m.items())) if m else m) for a, b, m in rows]
    assert digest(spark.createDataFrame(turned, schema)) == own
    others = [rows[:3], rows + rows[:1], [(None, 1, rows[0][2]), *rows[1:]], [rows[0], (1, None, None), *rows[2:]]]
    digests = {digest(spark.createDataFrame(r, schema)) for r in others}
    digests.add(digest(spark.createDataFrame(rows, "b int, a int, m map<string, int>")))
    assert own not in digests and len(digests) == 5


def test_footers_of_any_writer(spark, tmp_path, monkeypatch):
    one = pa.table({"i": pa.array([1], pa.int16()), "t": pa.array([0], pa.timestamp("us", tz="UTC"))})
    for n in range(70):
        pq.write_table(one, f"{tmp_path}/a{n:02d}.parquet")
    pq.write_table(one.append_column("u", pa.array([1], pa.uint32())), f"{tmp_path}/b.parquet")
    pq.write_table(one.set_column(1, "t", pa.array([0], pa.timestamp("us"))), f"{tmp_path}/c.parquet")
    (tmp_path / "d.parquet").write_bytes(b"PAR1PAR1")
    spark.range(1).selectExpr("id", "cast(id as timestamp) t").coalesce(1).write.parquet(f"{tmp_path}/e")
    own = next((tmp_path / "e").glob("part-*"))
    files = [*sorted(tmp_path.glob("*.parquet")), own, tmp_path / "gone.parquet"]
    read, asked = type(spark.read).parquet, []

    def counted(self, *paths, **options):
        asked.extend(paths)
        return read(self, *paths, **options)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark.read), "parquet", counted)
        found = file_schemas(spark, [f"file:{f}" for f in files], f"{tmp_path}/footers")
    assert len([a for a in asked if not a.endswith("/footers")]) == 4  # one of each kind
    for file in files[:-1]:
        schema, error = found[f"file:{file}"]
        if file.name == "d.parquet":
            assert schema is None and "cannot be read" in error
        else:
            assert (schema, error) == (spark.read.parquet(str(file)).schema.json(), None)
    assert found[f"file:{files[-1]}"][0] is None
