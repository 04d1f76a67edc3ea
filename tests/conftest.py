import os

import duckdb
import pytest
from pyspark.sql import SparkSession

TABLES_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Set SQL settings for one test."""
    before = {}

    def set_to(name, value):
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


def views_of(folder):
    connection = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        pattern = f"{folder}/{file}/*.parquet" if os.path.isdir(f"{folder}/{file}") else f"{folder}/{file}"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{pattern}'")
    return connection


@pytest.fixture(scope="session")
def tables_dir():
    return TABLES_DIR


@pytest.fixture(scope="session")
def duck(tables_dir):
    return views_of(tables_dir)


def rows_of(frame):
    """Rows of a pandas frame, columns by name, in a fixed order."""
    frame = frame[sorted(frame.columns)]
    # One class of missing value, and no numpy scalars, on both sides.
    rows = [
        tuple(None if value is None or value != value else value for value in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)
