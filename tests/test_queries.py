"""Every registered query against its SQL in DuckDB, over the smallest tables."""

from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as contract
from workload.oracle import oracle
from workload.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(df: pd.DataFrame) -> list[tuple]:
    def cell(value):
        if pd.isna(value):
            return ""
        if isinstance(value, float):
            return repr(value)
        return str(pd.Timestamp(value)) if hasattr(value, "year") else str(value)

    columns = sorted(df.columns)
    return sorted(zip(*[[cell(v) for v in df[c].astype(object)] for c in columns]))


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracle())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, str(TABLES)).toPandas()
    expected = duck.execute(oracle()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) > 0
    assert comparable(got) == comparable(expected)


def test_flagship_query(spark):
    assert contract.entry(spark).count() > 0


def test_no_query_needs_python_workers(spark):
    for name in ("silver_patients", "silver_encounters", "mart_patient_summary", "fhir_patients"):
        plan = QUERIES[name](spark, str(TABLES))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan
