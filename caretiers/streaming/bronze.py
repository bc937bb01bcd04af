"""Landing files to bronze tables, each file once.

Two streams are offered. The evolving one follows files whose header changes: it streams file names
and reads the new files of a micro-batch by their header. The fixed one is a plain CSV stream for
zones with a declared layout; it refuses files with another header.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from caretiers.config import DatasetConfig
from caretiers.functions import instant
from caretiers.schemas import INGESTED_AT, LANDING_DAY, LOAD_DATE, SOURCE_FILE
from caretiers.sources.delimited import MALFORMED
from caretiers.sources.tables import append_table
from caretiers.streaming.layouts import (
    Layout,
    LayoutRegistry,
    evolve_schema,
    first_header,
    read_by_header,
    read_headers,
    read_layout,
    text_schema,
)

log = logging.getLogger(__name__)

BATCH = "_batch"
# The file source leaves out files that are older than the newest one by more than this. Landing
# files must never be lost, whatever their date, so it is more than any two dates can differ.
ANY_AGE = "1000000d"
# Landing files, as they are or compressed.
LANDING_FILES = "*.{csv,csv.gz}"
FILE_LISTING = "path string, modificationTime timestamp, length long, content binary"


def cleaning(config: DatasetConfig) -> dict[str, str]:
    """Options of a stream whose files leave the zone once a later micro-batch has begun."""
    if config.archive_path is None:
        return {}
    return {"cleanSource": "archive", "sourceArchiveDir": config.archive_path}


def with_lineage(df: DataFrame, at: Column) -> DataFrame:
    """Add load time and load day; the file column must be read with the rows."""
    return df.withColumns({INGESTED_AT: at, LOAD_DATE: F.to_date(at)})


# --- fixed layout ---------------------------------------------------------------------------


def bronze_stream(
    spark: SparkSession, config: DatasetConfig, now: datetime | None = None
) -> DataFrame:
    """Streaming rows of a zone whose files all have the declared columns."""
    if config.columns is None:
        raise ValueError(f"{config.name} declares no columns")
    rows = (
        spark.readStream.schema(text_schema([*config.columns, LANDING_DAY, MALFORMED]))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", config.multi_line)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
        .option("maxFilesPerTrigger", config.max_files_per_trigger)
        .option("maxFileAge", ANY_AGE)
        .option("pathGlobFilter", LANDING_FILES)
        .options(**cleaning(config))
        .csv(config.source_path)
        .select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    )
    return with_lineage(rows, instant(now))


def run_bronze(
    stream: DataFrame, table: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Append what is new to a table partitioned by load day, then stop."""
    return (
        stream.writeStream.partitionBy(LOAD_DATE)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table, format=fmt)
    )


# --- evolving layout ------------------------------------------------------------------------


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Limit overwrites to the partitions that receive rows."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _write(rows: DataFrame, config: DatasetConfig, at: Column, batch: str) -> int:
    """Put one micro-batch into its own partition; a repeated micro-batch replaces itself.

    Returns the number of rows, which Spark counts as it writes them.
    """
    spark = rows.sparkSession
    in_path = F.regexp_extract(SOURCE_FILE, f"/{LANDING_DAY}=([^/]+)/", 1)
    in_data = F.col(LANDING_DAY) if LANDING_DAY in rows.columns else F.lit(None).cast("string")
    rows = rows.withColumn(LANDING_DAY, F.when(in_path != "", in_path).otherwise(in_data))
    rows = with_lineage(rows, at).withColumn(BATCH, F.lit(batch))

    columns = spark.table(config.target_table).columns
    absent = {c: F.lit(None).cast("string") for c in columns if c not in rows.columns}
    written = Observation()
    complete = rows.withColumns(absent).select(*[F.col(f"`{c}`") for c in columns])
    with dynamic_overwrite(spark):
        complete.observe(written, F.count(F.lit(1)).alias("rows")).write.insertInto(
            config.target_table, overwrite=True
        )
    return written.get["rows"]


def _prepare_table(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    """Create the table, or add the columns it does not have yet."""
    fields = ", ".join(f"`{c}` STRING" for c in columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} "
        f"({fields}, {MALFORMED} STRING, {SOURCE_FILE} STRING, {INGESTED_AT} TIMESTAMP, "
        f"{LOAD_DATE} DATE, {BATCH} STRING) "
        f"USING parquet PARTITIONED BY ({LOAD_DATE}, {BATCH})"
    )
    present = set(spark.table(table).columns)
    added = ", ".join(f"`{c}` STRING" for c in columns if c not in present)
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")


def _ingest_files(
    spark: SparkSession, config: DatasetConfig, paths: list[str], at: Column, batch: str
) -> int:
    """Read the files of a micro-batch and write their rows, whose number is returned.

    While files share one header, each is read once: with the header of the files before, which
    Spark compares with theirs as it reads them. Only when that read fails are all headers looked
    up, and where one of them differs the files are read in groups of equal headers; what the first
    attempt wrote was never committed. A failure with nothing but expected headers has another
    reason and is raised. After a mixed micro-batch the next one starts with the look-up.
    """
    registry = LayoutRegistry(spark, f"{config.checkpoint_path.rstrip('/')}/_layout")
    known = registry.layout
    header = known.header
    if not known.columns:
        header = first_header(spark, paths[0])

    def register(found: Iterable[tuple[str, ...]], shared: tuple[str, ...]) -> None:
        columns: Sequence[str] = known.columns
        for names in found:
            columns = evolve_schema(columns, names)
        _prepare_table(spark, config.target_table, evolve_schema(columns, [LANDING_DAY]))
        registry.save(Layout(tuple(columns), shared))

    headers: dict[str, tuple[str, ...]] = {}
    if header:
        register([header], header)
        try:
            rows = read_layout(spark, paths, header, strict=True, multi_line=config.multi_line)
            return _write(rows, config, at, batch)
        except Exception:
            headers = read_headers(spark, paths)
            if set(headers.values()) <= {header}:
                raise

    headers = headers or read_headers(spark, paths)
    distinct = list(dict.fromkeys(headers.values()))
    register(distinct, distinct[0] if len(distinct) == 1 else ())
    return _write(read_by_header(spark, headers, config.multi_line), config, at, batch)


# What a run took in, one row per micro-batch.
RUN_METRICS = "zone string, batch string, ingested_at timestamp, files long, n_rows long"


def ingest_bronze(
    spark: SparkSession,
    config: DatasetConfig,
    now: datetime | None = None,
    report: Callable[[tuple], None] = lambda row: None,
) -> StreamingQuery:
    """Start a run over the files that arrived since the last one; it stops by itself.

    The stream carries file names only, at most ``max_files_per_trigger`` per micro-batch. ``report`` is
    called with a row of ``RUN_METRICS`` for each of them.
    """
    at = F.unix_micros(instant(now)).alias("at")
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", LANDING_FILES)
        .option("maxFilesPerTrigger", config.max_files_per_trigger)
        .option("maxFileAge", ANY_AGE)
        .options(**cleaning(config))
        .load(config.source_path)
        .select("path", "length", at)
    )

    def write_batch(listing: DataFrame, batch_id: int) -> None:
        listed = listing.collect()
        found = [r for r in listed if r["length"] > 0]
        if len(found) < len(listed):
            log.warning("%s: %d files are empty", config.name, len(listed) - len(found))
        n_rows = 0
        session = listing.sparkSession
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        if found:
            n_rows = _ingest_files(
                session,
                config,
                [r["path"] for r in found],
                F.timestamp_micros(F.lit(found[0]["at"])),
                f"{query_id}-{batch_id}",
            )
        if listed:
            at_time = datetime.fromtimestamp(listed[0]["at"] / 1e6, timezone.utc)
            report((config.name, f"{query_id}-{batch_id}", at_time, len(listed), n_rows))

    return (
        files.writeStream.foreachBatch(write_batch)
        .outputMode("append")
        .option("checkpointLocation", config.checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for every query; the first failure is raised after all have ended."""
    failure: Exception | None = None
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:
            failure = failure or error
    if failure:
        raise failure


def run_all(
    spark: SparkSession,
    configs: Iterable[DatasetConfig],
    now: datetime | None = None,
    metrics_table: str | None = None,
) -> None:
    """Ingest several zones side by side.

    What they took in is appended to ``metrics_table``, one row per micro-batch (``RUN_METRICS``), also
    when one of them fails; a micro-batch that is repeated after a failure may be there twice.
    """
    configs = list(configs)
    taken_in: list[tuple] = []
    try:
        await_all([ingest_bronze(spark, c, now, taken_in.append) for c in configs])
    finally:
        if metrics_table and taken_in:
            rows = spark.createDataFrame(taken_in, RUN_METRICS).coalesce(1)
            append_table(rows, metrics_table)
    # The streams wrote through sessions of their own; forget what this one cached.
    for config in configs:
        if spark.catalog.tableExists(config.target_table):
            spark.catalog.refreshTable(config.target_table)
