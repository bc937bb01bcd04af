"""Keyed upsert: replace rows whose key arrives again, insert the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from caretiers.operators.latest import latest_by
from caretiers.sources.tables import fitted, publish, published

VERSION = "_version"
# Buckets of a table's data by key, fixed when it is first written.
BUCKETS = 16


def data_table(name: str) -> str:
    return f"{name}__data"


def upsert(
    batch: DataFrame,
    name: str,
    key: str,
    order: Sequence[str],
    compact_after: int = 16,
    buckets: int = BUCKETS,
    taken: int | Sequence[int] | None = None,
) -> None:
    """Upsert the newest batch row of each key into a table.

    The table is a view over versions: a batch is appended as a version of its own, so that an upsert
    writes what the batch holds, and the view shows the row of the newest version of each key. All
    versions are bucketed by the key, so the view finds the newest rows, and joins on the key find the
    table, without a shuffle. After ``compact_after`` versions the rows shown are written as one.
    A missing key is one key like any other, so running an upsert again changes nothing.
    ``taken`` is the last load of the source (of each source, if several) that the batch holds; it is
    shown with the rows, in one step (``taken_from_sources``). One writer at a time.
    """
    spark = batch.sparkSession
    newest = latest_by(batch, [key], order)
    state = published(spark, name)
    if state is None:
        # What an attempt that was never published has left is no part of the table.
        spark.sql(f"DROP TABLE IF EXISTS {data_table(name)}")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in newest.schema)
        spark.sql(
            f"CREATE TABLE {data_table(name)} ({fields}, {VERSION} INT) USING parquet "
            f"PARTITIONED BY ({VERSION}) CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS"
        )
        _append(newest, name, key, 1, 1, taken)
        return
    if len(state) != 2:
        raise ValueError(f"{name} is refreshed as a whole and cannot be upserted")
    base, last = state
    _append(fitted(newest, spark.table(name), name), name, key, base, last + 1, taken)
    if last + 1 - base >= compact_after:
        _append(spark.table(name), name, key, last + 2, last + 2, dealt=True)
        # Readers may still be on the versions that were just merged; those before are free.
        stale = spark.sql(f"SHOW PARTITIONS {data_table(name)}").collect()
        for partition in (r["partition"] for r in stale):
            if int(partition.partition("=")[2]) < base:
                _drop(spark, name, int(partition.partition("=")[2]))


def versions_since(spark: SparkSession, name: str, key: str, taken: int) -> tuple[DataFrame, int]:
    """Newest row of each key that was upserted after version ``taken``, and the last version.

    Versions that were merged since then cannot be told apart any more: all rows are returned.
    """
    base, last = published(spark, name)
    rows = spark.table(data_table(name)).where(F.col(VERSION).between(max(base, taken + 1), last))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(VERSION)))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank", VERSION), last


def buckets_of(spark: SparkSession, name: str) -> int | None:
    """Number of buckets of a table's data; tables of older releases have none."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {data_table(name)}")
    found = described.where("col_name = 'Num Buckets'").collect()
    return int(found[0]["data_type"]) if found else None


def _drop(spark: SparkSession, name: str, version: int) -> None:
    spark.sql(f"ALTER TABLE {data_table(name)} DROP IF EXISTS PARTITION ({VERSION} = {version})")


def _append(
    rows: DataFrame,
    name: str,
    key: str,
    base: int,
    version: int,
    taken: int | Sequence[int] | None = None,
    dealt: bool = False,
) -> None:
    """Write rows as a version, one file per bucket, and show the newest of each key from ``base`` on.

    Rows that are ``dealt`` come by bucket already.
    """
    spark = rows.sparkSession
    _drop(spark, name, version)
    buckets = buckets_of(spark, name)
    by_bucket = rows if dealt or not buckets else rows.repartition(buckets, F.col(f"`{key}`"))
    by_bucket.withColumn(VERSION, F.lit(version)).write.insertInto(data_table(name))
    shown = ", ".join(f"`{c}`" for c in rows.columns)
    ranked = (
        f"SELECT *, row_number() OVER (PARTITION BY `{key}` ORDER BY {VERSION} DESC) AS _rank "
        f"FROM {data_table(name)} WHERE {VERSION} BETWEEN {base} AND {version}"
    )
    publish(spark, name, f"{base},{version}", f"SELECT {shown} FROM ({ranked}) WHERE _rank = 1", taken)
