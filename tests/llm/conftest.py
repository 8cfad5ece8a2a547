import pytest


@pytest.fixture(autouse=True)
def _package_on_workers(spark):
    from ebbflow.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    from cases import documents

    return documents(spark)


@pytest.fixture(scope="session")
def none(spark):
    from cases import empty

    return empty(spark)
