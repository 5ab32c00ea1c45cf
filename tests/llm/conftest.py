import pytest


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    from voxspark.llm.common import importable
    importable(spark)
