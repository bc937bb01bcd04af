from pathlib import Path

import pytest

import corpus_pipeline

TABLES = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not TABLES.exists(), reason="needs the test tables")
def test_stages_keep_columns_and_lose_nothing_clean(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    first, columns = docs, docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(TABLES))
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert 0 < docs.count() <= first.count()
            last = docs
    assert {r[0] for r in docs.select("doc_id").distinct().collect()} == {r[0] for r in last.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, str(TABLES)).count() == docs.count()
