import pytest

from tallyloom.llm.texts import importable


@pytest.fixture(autouse=True)
def workers_find_the_library(spark):
    importable(spark)
