"""Helpers the training-data operators share."""

from __future__ import annotations

import gc
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemill.session import work_dir, written

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers import the package from this checkout where it is not installed."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, *paths) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Workspace:
    """Tables of one run in the shared folder. ``keep`` writes a DataFrame once and reads it back,
    which cuts its lineage: an executor lost later costs no recomputation. ``forget`` removes a table
    that nothing reads any more, ``close`` all that are left, once the run's result is written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = work_dir(spark)
        self._count = 0
        self._paths: dict[str, list[str]] = {}

    def path(self, name: str) -> str:
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        self._paths.setdefault(name, []).append(path)
        return path

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, self.path(name))

    def replace(self, df: DataFrame, name: str) -> DataFrame:
        """``keep``, in place of earlier tables of this name, which only ``df`` still needed."""
        earlier = self._paths.pop(name, [])
        out = self.keep(df, name)
        for path in earlier:
            self._delete(path)
        return out

    def forget(self, name: str) -> None:
        for path in self._paths.pop(name, []):
            self._delete(path)

    def tidy(self) -> None:
        """Let Spark's cleaner remove shuffle files of finished steps now; it goes by what garbage
        collection finds, and a small driver heap collects seldom."""
        gc.collect()
        self.spark._jvm.System.gc()

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        system.delete(where, True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the rows' offsets into them; null rows are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]
