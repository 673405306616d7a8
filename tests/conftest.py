import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")
TABLES = ("lineitem", "orders", "part", "supplier", "pages")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("parcelflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from parcelflow.sources import release

    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection
