"""CSV layouts: which columns files bring, and the registry of all columns seen so far."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caretiers.schemas import SOURCE_FILE
from caretiers.sources.delimited import MALFORMED, csv_reader
from caretiers.sources.lines import first_line_of_each

REGISTRY_SCHEMA = "version int, columns array<string>, header array<string>"


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def evolve_schema(registered: Sequence[str], observed: Sequence[str]) -> list[str]:
    """Registered columns in their order, then those seen for the first time."""
    known = set(registered)
    return [*registered, *[c for c in dict.fromkeys(observed) if c not in known]]


@dataclass(frozen=True)
class Layout:
    """All columns of a dataset, and the header its last files shared, empty if they differed."""

    columns: tuple[str, ...] = ()
    header: tuple[str, ...] = ()


class LayoutRegistry:
    """Layouts of a dataset, one appended version per change, kept beside its checkpoint."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path
        self._version = 0
        self.layout = Layout()
        self._load()

    def _load(self) -> None:
        try:
            versions = self._spark.read.schema(REGISTRY_SCHEMA).json(self._path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return
            raise
        newest = versions.orderBy(F.desc("version")).limit(1).collect()
        if newest:
            self._version = newest[0]["version"]
            self.layout = Layout(tuple(newest[0]["columns"]), tuple(newest[0]["header"]))

    def save(self, layout: Layout) -> None:
        if layout == self.layout:
            return
        self._version += 1
        row = (self._version, list(layout.columns), list(layout.header))
        rows = self._spark.createDataFrame([row], REGISTRY_SCHEMA)
        rows.coalesce(1).write.mode("append").json(self._path)
        self.layout = layout


def parse_header(line: str, path: str) -> tuple[str, ...]:
    names = tuple(n.strip().lower() for n in next(csv.reader([line.lstrip("\ufeff")]), []))
    if not names or "" in names or len(set(names)) < len(names):
        raise ValueError(f"{path} has no usable header: {line!r}")
    return names


def literal_path(path: str) -> str:
    """Path that is not taken for a pattern when a reader opens it."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def first_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Header of one file; reads no more than its beginning."""
    lines = spark.read.text(literal_path(path)).limit(1).collect()
    return parse_header(lines[0]["value"] if lines else "", path)


def read_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Header of each file; no file is read beyond its first line."""
    found = first_line_of_each(spark, [literal_path(p) for p in paths])
    return {unquote(path): parse_header(line, path) for path, line in found.items()}


def read_layout(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], strict: bool, multi_line: bool
) -> DataFrame:
    """Files of one layout as text columns, with the path of each row's file.

    A record that does not fit the header keeps its whole text in a column of its own.
    """
    reader = csv_reader(spark, strict, multi_line).schema(text_schema([*header, MALFORMED]))
    reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
    rows = reader.csv([literal_path(p) for p in paths])
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def read_by_header(
    spark: SparkSession, headers: dict[str, tuple[str, ...]], multi_line: bool
) -> DataFrame:
    """Files of several layouts as one frame, matched by column name."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in headers.items():
        groups.setdefault(header, []).append(path)
    frames = [
        read_layout(spark, paths, header, strict=False, multi_line=multi_line)
        for header, paths in groups.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
