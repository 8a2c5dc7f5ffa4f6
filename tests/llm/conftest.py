import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from helpers import SCHEMA, hard_docs  # noqa: E402


@pytest.fixture(scope="session")
def hard(spark):
    return hard_docs(spark)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
