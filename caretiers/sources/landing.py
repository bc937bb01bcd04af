"""Date-partitioned landing zone of CSV files."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, functions as F

# Doubled quotes, and blanks around values kept as they are.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# Files with line breaks inside values are read by one task each, so files are kept small.
ROWS_PER_FILE = 500_000


def land(
    df: DataFrame,
    root: str,
    load_date: date | str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    compression: str = "none",
) -> None:
    """Write the rows below ``root/load_date=YYYY-MM-DD``, replacing that day only.

    The files of a repeated day get new names, so a bronze run that already took in the first
    version takes in the second one too; silver then keeps the newest row of each key.
    """
    day = str(load_date or datetime.now(timezone.utc).date())
    (
        df.withColumn("load_date", F.lit(day))
        .write.partitionBy("load_date")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", compression)
        .options(**CSV_WRITE_OPTIONS)
        .csv(root)
    )
