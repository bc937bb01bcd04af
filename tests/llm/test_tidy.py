from caretiers.llm import common


def test_finished_jobs_are_tidied_away_while_tables_are_written(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(common, "tidy", calls.append)
    for _ in range(common.TIDY_EVERY):
        common.materialize(spark.range(3), "few")
    assert calls == [spark]


def test_tidy_leaves_tables_readable(spark):
    made = common.materialize(spark.range(5).repartition(3), "kept")
    common.tidy(spark)
    assert made.count() == 5
