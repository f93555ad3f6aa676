import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A frame from {column: values}; numbers become doubles unless a schema is given."""

    def make(columns, schema=None):
        rows = list(zip(*columns.values()))
        if schema is None:
            schema = ", ".join(f"`{c}` double" for c in columns)
            rows = [tuple(None if v is None else float(v) for v in row) for row in rows]
        return spark.createDataFrame(rows, schema)

    return make


def values(df, column):
    return [row[column] for row in df.collect()]
