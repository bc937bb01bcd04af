"""Helpers shared by the operators: shared scratch tables, dense ranks, components, word hashes."""

from __future__ import annotations

import gc
import hashlib
import itertools
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Scratch tables made so far.
_made: list[str] = []
#: Where a scratch table that was read back lies.
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

#: Memory that a Python worker may spend on remembered words, as a number of entries.
CACHE_WORDS = 200_000
#: Rows per Arrow batch, unless the session says otherwise: rows with whole texts are large.
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; only where that is unset (tests) a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.startswith("local["):
            root = tempfile.mkdtemp(prefix="llm-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    path = f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


#: Scratch tables written between two calls of tidy.
TIDY_EVERY = 8
_written = itertools.count(1)


def tidy(spark: SparkSession) -> None:
    """Lets Spark remove shuffle files and broadcasts of finished jobs. It does so when the driver's garbage
    collection finds that nothing refers to them, which may be never while the driver has memory left."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to a shared scratch table and reads it back: short lineage, known size, no rerun."""
    if next(_written) % TIDY_EVERY == 0:
        tidy(df.sparkSession)
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def made_so_far() -> list[str]:
    return list(_made)


def remove(spark: SparkSession, made: str) -> None:
    """Removes a scratch table that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(made)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if made in _made:
        _made.remove(made)


def discard(*tables: DataFrame) -> None:
    """Removes scratch tables (as materialize returned them) that nothing reads any more, and what finished
    jobs have left."""
    for table in tables:
        remove(table.sparkSession, _paths.pop(table))
    tidy(tables[0].sparkSession)


def release(spark: SparkSession, keep: list[str]) -> None:
    """Removes the scratch tables but those to keep, once everything built on them is written."""
    for made in [m for m in _made if m not in keep]:
        remove(spark, made)
    tidy(spark)


def partitions_for(spark: SparkSession, size: int, each: int) -> int:
    """At least the session's shuffle partitions, more where one would exceed `each` bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def dense_rank(df: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Numbers the rows of df (distinct in `keys`) from 1 in the order of `keys`.

    A range shuffle orders the rows across partitions; each partition numbers its own rows and is
    shifted by the counts before it, of which the driver sees one per partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    numbered = materialize(
        ordered.select(*df.columns, F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().alias("__m")),
        "rank",
    ).withColumn("__m", F.col("__m").bitwiseAND(F.lit((1 << 33) - 1)))
    shift, before = [], 0
    for row in numbered.groupBy("__p").count().orderBy("__p").collect():
        shift.append((row["__p"], before))
        before += row["count"]
    offsets = spark.createDataFrame(shift, "__p int, __before long")
    return numbered.join(F.broadcast(offsets), "__p").select(
        *df.columns, (F.col("__before") + F.col("__m") + 1).alias(rank)
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of links (a, b): the smallest node reachable.

    Every round takes the least label among a node and its neighbours and then the label of that
    label, so long chains halve. Rounds end when no label changes. All steps are joins and
    aggregates with map-side minima, so that a hub is one row per task.
    """
    both = materialize(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("a").alias("b"), F.col("c").alias("d")), "b")
            .groupBy("a")
            .agg(F.min("d").alias("d"))
        )
        step = labels.join(near, "a").select("a", "c", F.least("c", "d").alias("d"))
        jump = labels.select(F.col("a").alias("d"), F.col("c").alias("e"))
        new = materialize(
            step.join(jump, "d").select("a", F.least("d", "e").alias("c"), (F.least("d", "e") != F.col("c")).alias("moved")),
            "labels",
        )
        labels = new.select("a", "c")
        if new.filter("moved").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("c").alias("component"))


def text_key(text: Column) -> Column:
    """A 128-bit key of a text; a null text has that of an empty one."""
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))


def digest(data: bytes) -> bytes:
    return hashlib.md5(data, usedforsecurity=False).digest()


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a sequence of 64-bit hashes."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for k in range(1, n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
    return mix(total)


def raw_texts(batch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column of an Arrow batch, empty for null."""
    return [x or b"" for x in batch.column(column).cast("binary").to_pylist()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Prepares a session, once per application: sends this package to the executors' Python workers and
    bounds the batches they get."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
