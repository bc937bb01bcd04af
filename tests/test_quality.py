from datetime import datetime

import pytest

from caretiers.operators.quality import (
    check_accepted,
    check_freshness,
    check_not_null,
    check_range,
    check_unique,
    quality_filters,
)

from conftest import plan_of, rows


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [("a", 1.0, "M"), ("a", -1.0, "F"), (None, 5.0, None), ("b", None, "X"), (None, 9.0, "M")],
        "k string, v double, g string",
    )


def test_not_null(df):
    assert rows(check_not_null(df, ["k"]), "v") == [(5.0,), (9.0,)]
    assert check_not_null(df, ["k", "v"]).count() == 3


def test_unique(df):
    assert rows(check_unique(df, ["k"])) == [(None, 2), ("a", 2)]
    assert check_unique(df, ["k", "v"]).count() == 0
    assert "partial_count" in plan_of(check_unique(df, ["k"]))


def test_accepted(df):
    assert rows(check_accepted(df, "g", ["M", "F"]), "k") == [("b",)]


def test_range(df):
    assert rows(check_range(df, "v", low=0, high=5), "v") == [(-1.0,), (9.0,)]
    assert rows(check_range(df, "v", high=5), "v") == [(9.0,)]
    assert check_range(df, "v").count() == 0


def test_freshness(spark):
    loads = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 2),)], "t timestamp")
    now = datetime(2024, 1, 2, 6)
    assert rows(check_freshness(loads, "t", 6, now)) == [(datetime(2024, 1, 2), 6.0, True)]
    assert rows(check_freshness(loads, "t", 5, now), "is_fresh") == [(False,)]
    assert rows(check_freshness(loads.limit(0), "t", 5, now)) == [(None, None, False)]


def test_quality_filters(spark):
    df = spark.createDataFrame(
        [("ok", 0.0, 5.0, 5.0), (None, 1.0, 5.0, 1.0), ("a", -1.0, 5.0, 1.0), ("b", None, 5.0, 1.0),
         ("c", 1.0, -5.0, -9.0), ("d", 1.0, 5.0, 6.0)],
        "encounter_id string, encounter_duration_minutes double, total_claim_cost double, "
        "payer_coverage double",
    )
    assert rows(quality_filters(df), "encounter_id") == [("ok",)]
