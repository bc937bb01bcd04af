"""From raw documents to packed sequences: five stages, each one operator over all that is left.

run() applies the stages to `documents`. Every stage's result is written as Parquet to a shared
folder and read back as the next stage's documents. All stages but the last return the columns of
documents. Their semantics (blocks, edit distances, packing) are beyond SQL; tests/llm holds each
against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretiers.llm import decontaminate, line_dedup, ngram_join, packing, quality_rules
from caretiers.llm.common import made_so_far, release, scratch, ship

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    ship(spark)
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line runs that stand earlier; a document of which nothing is left goes."""
    ship(spark)
    cut = line_dedup.remove_later_lines(docs)
    left = F.coalesce(F.col("n_removed") < F.col("n_lines"), F.lit(True)) | (F.col("n_removed") == 0)
    return cut.filter(left).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    ship(spark)
    return ngram_join.keep_one(docs, n=5, num=80, den=100)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    ship(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = made_so_far()
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = scratch(spark, name.replace(" ", "-"))
        out.write.parquet(path)
        # What the stage and the one before have left is not needed any more.
        release(spark, [*before, path])
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
