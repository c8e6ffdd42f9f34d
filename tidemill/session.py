"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results or plans rely on. Everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

SPLIT_BYTES = 512 * 1024**2

_own_dirs: dict[str, str] = {}


def local_session(cores: str | int = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` on ``cores``: scan and shuffle partitions of about
    ``SPLIT_BYTES``, at least one per core. Adaptive execution merges what turns out small."""
    partitions = max(-(-input_bytes // SPLIT_BYTES), cores)
    return {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SPLIT_BYTES // 2),
    }


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session in one process may go without that setting; it then gets a temporary folder of its
    own. ``local-cluster`` has executors in other processes and may not.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        app = spark.sparkContext.applicationId
        shared = _own_dirs.setdefault(app, tempfile.mkdtemp(prefix="run-"))
    return f"{shared.rstrip('/')}/tidemill-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: a short lineage, a result that cannot change between
    uses, and real size statistics for the planner. ``codec`` is Parquet's, the session's by default."""
    writer = df.write.mode("overwrite")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
