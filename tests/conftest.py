import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from postsieve import build_session  # noqa: E402

# Made on import, since column expressions at the top of test modules need a session.
SPARK = build_session(
    "tests", "local[8]",
    **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="postsieve-tests-"),
    },
)
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SPARK
    SPARK.stop()


@pytest.fixture
def value(spark):
    """Evaluate a column expression over one row of named values."""

    def run(expr, schema="x string", **row):
        return spark.createDataFrame([tuple(row.values())], schema).select(expr.alias("out")).first()["out"]

    return run
