import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oreline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", 8, **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Values of one expression over a frame of literals."""

    def run(data, schema, *columns):
        df = spark.createDataFrame(data, schema).select(*columns)
        return [tuple(r) if len(columns) > 1 else r[0] for r in df.collect()]

    return run
