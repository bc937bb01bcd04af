import tempfile
import uuid

import pytest
from pyspark.sql import SparkSession

from caretiers.config import tune_session


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="caretiers-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", f"{root}/warehouse")
        .config("spark.checkpoint.dir", f"{root}/scratch")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield tune_session(session)
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    """Rows as a sorted list of tuples; NULLs sort first."""
    found = (df.select(*columns) if columns else df).collect()
    return sorted(map(tuple, found), key=lambda r: [(v is not None, v) for v in r])
