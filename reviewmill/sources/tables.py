"""Scans of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.schemas import (
    MODEL_METRICS,
    PARTITION_COLUMNS,
    PREDICTION,
    REVIEW_COLUMNS,
    SCALING,
    STORED_REVIEW,
)
from reviewmill.session import path_exists
from reviewmill.sinks.commits import snapshot_folders


def read_bronze(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """Reviews of the runs that are committed now; a day range also becomes a month folder filter.

    The folders are listed once, when this is called, so a table that changes later is still read
    as it was.
    """
    folders = snapshot_folders(spark, path)
    reader = spark.read.schema(STORED_REVIEW).option("basePath", path)
    stored = reader.parquet(*folders) if folders else spark.createDataFrame([], STORED_REVIEW)
    month = F.col("review_year") * 12 + F.col("review_month")
    if first_day is not None:
        year, mon, _ = (int(p) for p in first_day.split("-"))
        stored = stored.where(month >= year * 12 + mon)
        stored = stored.where(F.to_date("review_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        year, mon, _ = (int(p) for p in last_day.split("-"))
        stored = stored.where(month <= year * 12 + mon)
        stored = stored.where(F.to_date("review_date") <= F.lit(last_day).cast("date"))
    partition_columns = [c for c in PARTITION_COLUMNS if c not in REVIEW_COLUMNS]
    return stored.select(*REVIEW_COLUMNS, *partition_columns)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTION).parquet(path)


def read_model_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics records, whether one per line or one pretty-printed record per file."""
    return spark.read.schema(MODEL_METRICS).option("multiLine", True).json(path)


def model_rows(metrics: DataFrame) -> DataFrame:
    """One row per model; a value that one of the models lacks is null."""
    return metrics.selectExpr("inline(models)")


def read_scaling(spark: SparkSession, path: str) -> DataFrame:
    """The scaling table, or an empty one where none was written."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], SCALING)
    return spark.read.schema(SCALING).option("header", True).csv(path)
