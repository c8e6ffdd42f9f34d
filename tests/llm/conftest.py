import pytest

from tidemill.llm.common import Workspace, importable


@pytest.fixture
def work(spark):
    importable(spark)
    return Workspace(spark)
