"""Dataset and pipeline settings, session options and scratch storage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import SparkSession

# Runtime SQL options the jobs rely on. Cluster sizing (shuffle partitions, memory, broadcast
# threshold) is left to the session: AQE coalesces small partitions and splits skewed ones.
SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime options above to a session and return it."""
    for key, value in SESSION_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared ``spark.checkpoint.dir`` of the session.

    A local folder is used only when the setting is absent and Spark runs in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="caretiers-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished jobs, which it does when the driver's garbage is
    collected; while the driver has memory left that may be never."""
    gc.collect()
    spark._jvm.System.gc()


@dataclass(frozen=True)
class DatasetConfig:
    """One landing zone and the bronze table it feeds.

    ``max_files_per_trigger`` bounds a micro-batch, and with it the list of file names the
    driver holds. ``multi_line`` reads values with line breaks, which landing files may hold; only
    zones without any may turn it off, to split huge files. ``columns`` is only needed for the
    fixed-layout stream. With ``archive_path``, a folder outside the zone, files that were taken in are
    moved there, below their old path, when the next ones are taken in: a run then lists the files
    of the last micro-batch and new ones, not all that ever came.
    """

    name: str
    source_path: str
    checkpoint_path: str
    target_table: str
    max_files_per_trigger: int = 10_000
    multi_line: bool = True
    columns: tuple[str, ...] | None = None
    archive_path: str | None = None


@dataclass(frozen=True)
class Layers:
    """Database names of the three table layers."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def create(self, spark: SparkSession, root: str | None = None) -> None:
        for name in (self.bronze, self.silver, self.gold):
            where = f" LOCATION '{root.rstrip('/')}/{name}'" if root else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


@dataclass(frozen=True)
class PipelineConfig:
    """Inputs and outputs of one end-to-end run; a source left ``None`` is skipped.

    ``multi_line`` allows line breaks inside CSV values; such files cannot be split.
    ``checks`` makes the run write the failing rows of the gold tables to ``failed_checks``.
    ``compact_after`` is how many upserts are kept apart before they are merged, and ``buckets`` how
    many files by key an upserted table has per version, fixed when it is first written. ``now`` sets
    the clock. ``archive_root`` is where landing files go once they are in bronze (default: they stay).
    ``gold_mode`` is "refresh" (fact and mart are rebuilt by every run) or "incremental" (a run adds
    what is new in silver and recomputes the patients that it touches); the latter adds up loads,
    so silver must be appended. It is chosen when gold is first built.
    """

    landing_root: str
    checkpoint_root: str
    warehouse_root: str | None = None
    fhir_path: str | None = None
    fhir_multiline: bool = True
    patients_csv: str | None = None
    encounters_csv: str | None = None
    multi_line: bool = True
    layers: Layers = field(default_factory=Layers)
    silver_mode: str = "append"
    compact_after: int = 16
    buckets: int = 16
    gold_mode: str = "refresh"
    checks: bool = False
    archive_root: str | None = None
    now: datetime | None = None

    def __post_init__(self) -> None:
        if self.gold_mode == "incremental" and self.silver_mode != "append":
            raise ValueError("gold can only be incremental over silver tables that are appended")

    def datasets(self) -> list[DatasetConfig]:
        """The four zones: two sources for each of two entities."""
        return [
            DatasetConfig(
                name=f"raw_{entity}_{source}",
                source_path=f"{self.landing_root}/{source}/{entity}",
                checkpoint_path=f"{self.checkpoint_root}/raw_{entity}_{source}",
                target_table=f"{self.layers.bronze}.raw_{entity}_{source}",
                multi_line=self.multi_line,
                archive_path=self.archive_root,
            )
            for entity in ("patients", "encounters")
            for source in ("api", "csv")
        ]
