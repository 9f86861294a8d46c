"""Writers for stored tables, logs and dashboard files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.operators.layout import clustered_for_write, with_month_partitions
from reviewmill.schemas import PARTITION_COLUMNS, REVIEW_COLUMNS, STORED_REVIEW
from reviewmill.session import remove_folder
from reviewmill.sinks.commits import (
    RUN_FOLDER,
    commit,
    next_place,
    read_commits,
    snapshot,
    unreferenced,
)


# The same for writing and reading.
CSV = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def run_path(path: str, run: str) -> str:
    """The folder of one run's log: of a batch ingest, or of one micro-batch of one stream."""
    return f"{path}/{RUN_FOLDER}={run}"


def write_bronze(
    valid: DataFrame, path: str, run: str, replaces: list[str] | None = None
) -> DataFrame:
    """Store valid reviews in the month folders of their run, commit them, and return them.

    Batch and stream share this layout, so one table can take both. A run that is repeated takes the
    place of its earlier rows at the moment it is complete, and touches no other run.
    """
    spark = valid.sparkSession
    version, folder = next_place(spark, path, run)
    rows = clustered_for_write(with_month_partitions(valid))
    rows.write.mode("overwrite").partitionBy(*PARTITION_COLUMNS).parquet(f"{path}/{folder}")
    stored = spark.read.schema(STORED_REVIEW).option("basePath", f"{path}/{folder}").parquet(
        f"{path}/{folder}"
    )
    commit(spark, path, [(version, run, folder, stored.count(), replaces or [])])
    return stored.select(*REVIEW_COLUMNS)


def compact_bronze(
    spark: SparkSession, path: str, out: str | None = None, run: str = "compacted"
) -> None:
    """Rewrite the committed runs as one, with a few large files per month.

    Without ``out`` the merged run takes the others' place in the same table: until its record is
    written they are read, afterwards it is.
    """
    held = [row["folder"] for row in snapshot(read_commits(spark, path)).collect()]
    folders = [f"{path}/{folder}" for folder in held]
    rows = spark.read.schema(STORED_REVIEW).option("basePath", path).parquet(*folders)
    rows = rows.select(*REVIEW_COLUMNS)
    write_bronze(rows, out or path, run, replaces=None if out else held)


def vacuum_bronze(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders that repeated or merged runs have left, and return their paths.

    For times when nobody reads an earlier state of the table.
    """
    gone = unreferenced(spark, path)
    for folder in gone:
        remove_folder(spark, folder)
    return gone


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_log(rows: DataFrame, path: str, run: str) -> None:
    """Replace the JSON lines of one run."""
    rows.write.mode("overwrite").json(run_path(path, run))


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV files with a header; as many files as the table has partitions, in its sort order.

    Quotes within a value are doubled, which other readers of CSV expect, and white space around
    values stays.
    """
    writer = rows.write.mode("overwrite").option("header", True).options(**CSV)
    writer.csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: str, corrupt: str | None = None
) -> DataFrame:
    """Files that ``write_csv`` wrote; values may hold commas, quotes and line breaks.

    With ``corrupt``, the name of a column to add, a line that does not fit the schema is kept there
    as it stands, and its other columns hold what could be read. Without it they are all that shows.
    Line breaks inside values keep a file in one task, so this is for tables the size of dashboards.
    """
    if corrupt is not None:
        schema = f"{schema}, {corrupt} string"
    reader = spark.read.schema(schema).option("header", True).options(**CSV)
    if corrupt is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.option("multiLine", True).option("mode", "PERMISSIVE").csv(path)
