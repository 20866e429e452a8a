"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tillwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a column rule to a list of values and return the results in order."""

    def apply(rule, values, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(values)), f"place int, value {kind}")
        result = rows.select("place", rule(F.col("value")).alias("result")).orderBy("place").collect()
        return [row["result"] for row in result]

    return apply
