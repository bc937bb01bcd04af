"""The queries with SQL against DuckDB, and all of them for shape, over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from caretiers.llm.queries import ORACLE, QUERIES

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="needs the test tables")


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got = QUERIES[name](spark, str(TABLES))
    expected = duck.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(expected.fetchall())


def test_an_operator_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
