from types import SimpleNamespace

import pytest

from tidemill.session import SPLIT_BYTES, settings_for, work_dir


def fake(master: str, shared: str | None = None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared or default), sparkContext=context
    )


@pytest.mark.parametrize(
    "size, cores, partitions",
    [(0, 8, 8), (SPLIT_BYTES * 20, 8, 20), (SPLIT_BYTES * 20 + 1, 8, 21), (100 * 10**12, 4000, 186265)],
)
def test_partitions_stay_small_at_any_size(size, cores, partitions):
    settings = settings_for(size, cores)
    assert settings["spark.sql.shuffle.partitions"] == str(partitions)
    assert settings["spark.sql.files.maxPartitionBytes"] == str(SPLIT_BYTES)


def test_only_one_process_may_do_without_a_shared_folder():
    for master in ("local", "local[*]", "local[4]", "local[4,2]"):
        assert work_dir(fake(master)).startswith("/")
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(fake(master))
    first, second = (work_dir(fake("yarn", "s3a://x/shared/")) for _ in range(2))
    assert first.startswith("s3a://x/shared/tidemill-") and first != second
