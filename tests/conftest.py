"""One local session for all tests; ANSI mode stays on, as Spark sets it."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("granary-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a DDL schema."""

    def build(schema, *values):
        return spark.createDataFrame(list(values), schema)

    return build


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def metrics(df):
    """Tidy rows as {(check, column, metric): value}."""
    return {(r["check"], r["column"], r["metric"]): r["value"] for r in df.collect()}
