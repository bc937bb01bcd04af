"""Catalog tables: scans, appends, loads, and replacements that readers see all at once.

A replaced table is a view over data tables. New rows are written where the view does not look yet;
re-creating the view is the single step that publishes them. A job that dies before that step leaves
readers with the old rows, and running it again gives the right result. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, ShortType

VERSION_PROPERTY = "caretiers.version"
# How much of its source a table holds: the last load or version of the source that was taken in.
TAKEN_PROPERTY = "caretiers.taken"
LOAD_DAY, LOAD = "_load_day", "_load"
# A value of the first type is held by the second without loss.
SAFE_WIDENING: set[tuple[DataType, DataType]] = {
    (ShortType(), IntegerType()), (ShortType(), LongType()), (IntegerType(), LongType()),
    (FloatType(), DoubleType()), (ShortType(), DoubleType()), (IntegerType(), DoubleType()),
}


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").saveAsTable(name)


def fitted(batch: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """The batch with the columns of the target; types may only be widened."""
    have, want = ({f.name: f.dataType for f in df.schema} for df in (batch, target))
    if set(have) != set(want):
        raise ValueError(f"{name} has the columns {list(want)}, the new rows have {list(have)}")
    for column, kind in want.items():
        if have[column] != kind and (have[column], kind) not in SAFE_WIDENING:
            raise ValueError(f"{name}.{column} is {kind.simpleString()}, not {have[column].simpleString()}")
    return batch.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in want.items()])


# --- tables of loads ------------------------------------------------------------------------


def loads(spark: SparkSession, name: str) -> list[int]:
    """Numbers of the loads of a table; looks at the catalog only."""
    partitions = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return sorted(int(r["partition"].rpartition(f"{LOAD}=")[2]) for r in partitions)


def load_days(spark: SparkSession, name: str, after: int = 0) -> dict[int, str]:
    """The day of every load above ``after``, in their order; looks at the catalog only."""
    partitions = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    found = [(int(p.rpartition("=")[2]), p.partition("=")[2].partition("/")[0]) for p in partitions]
    return dict(sorted((number, day) for number, day in found if number > after))


def rows_of_load(spark: SparkSession, name: str, number: int) -> DataFrame:
    return spark.table(name).where(F.col(LOAD) == number).drop(LOAD_DAY, LOAD)


def append_load(
    df: DataFrame, name: str, day: date | str | None = None, number: int | None = None
) -> int:
    """Append rows as a load of their own and return its number (default: one more than the last).

    Every load is a partition, below the partition of its day (default: today, UTC), so that readers
    can take a day or what is new since a load without looking at the rest. A load whose write died is
    not in the catalog: the next one has its number and replaces what it has left. One writer at
    a time.
    """
    spark = df.sparkSession
    day = str(day or datetime.now(timezone.utc).date())
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(
            f"CREATE TABLE {name} ({fields}, {LOAD_DAY} DATE, {LOAD} INT) "
            f"USING parquet PARTITIONED BY ({LOAD_DAY}, {LOAD})"
        )
    number = number or max(loads(spark, name), default=0) + 1
    rows = fitted(df, spark.table(name).drop(LOAD_DAY, LOAD), name)
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({LOAD_DAY} = DATE '{day}', {LOAD} = {number}) "
        "SELECT * FROM {rows}",
        rows=rows,
    )
    return number


def loads_since(spark: SparkSession, name: str, taken: int) -> tuple[DataFrame, int]:
    """Rows of the loads after number ``taken``, and the last number they reach."""
    last = max(loads(spark, name), default=0)
    rows = spark.table(name).where((F.col(LOAD) > taken) & (F.col(LOAD) <= last))
    return rows.drop(LOAD_DAY, LOAD), last


# --- published tables -----------------------------------------------------------------------


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """Properties of a table or view; none where there is no such name."""
    if not spark.catalog.tableExists(name):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def published(spark: SparkSession, name: str) -> list[int] | None:
    """The numbers in a view's version property, or None where there is no such view."""
    if not spark.catalog.tableExists(name):
        return None
    version = properties(spark, name).get(VERSION_PROPERTY)
    if version is None:
        raise ValueError(f"{name} was not written by materialize_table or upsert")
    return [int(n) for n in version.split(",")]


def taken_from_sources(spark: SparkSession, name: str, sources: int) -> list[int]:
    """The last load of each of its sources that a published table holds, 0 where it holds none."""
    found = properties(spark, name).get(TAKEN_PROPERTY, "0").split(",")
    return [int(n) for n in found] + [0] * (sources - len(found))


def taken_from_source(spark: SparkSession, name: str) -> int:
    """The last load of its only source that a published table holds, 0 if it holds none."""
    return taken_from_sources(spark, name, 1)[0]


def publish(
    spark: SparkSession, name: str, version: str, body: str, taken: int | Sequence[int] | None = None
) -> None:
    """Show new rows and, in the same step, how much of the sources they hold (default: as before)."""
    if taken is None:
        taken = taken_from_sources(spark, name, 1)
    held = ",".join(map(str, [taken] if isinstance(taken, int) else taken))
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES "
        f"('{VERSION_PROPERTY}' = '{version}', '{TAKEN_PROPERTY}' = '{held}') AS {body}"
    )


def refreshed_table(name: str, version: int) -> str:
    return f"{name}__{version}"


def materialize_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Full refresh: readers see the old rows until all new ones are written.

    Every refresh has a data table of its own, so columns and types are those of the new rows. The
    last one before is kept for readers that are still on it.
    """
    if fmt != "parquet":
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", True).saveAsTable(name)
        return
    spark = df.sparkSession
    version = (published(spark, name) or [0])[0] + 1
    table = refreshed_table(name, version)
    # An attempt that died before it was published may have left a table.
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.format("parquet").mode("overwrite").saveAsTable(table)
    publish(spark, name, str(version), f"SELECT * FROM {table}")
    if version > 2:
        spark.sql(f"DROP TABLE IF EXISTS {refreshed_table(name, version - 2)}")
