"""Roll-ups kept beside the stored reviews, so that dashboards read no reviews.

Each folder of the table that is committed has its own partial counts by category and day, written
once. A dashboard sums the parts of the folders that the table holds at that time: what a repeated or
merged run has replaced drops out by itself, and only new folders are ever read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators.dashboards import category_days
from reviewmill.operators.features import silver_reviews
from reviewmill.schemas import STORED_REVIEW
from reviewmill.sinks.commits import RUN_FOLDER, commit, newest_version, read_commits, snapshot

# Below the table, where readers of the reviews do not look.
ROLLUPS = "_category_days"
PARTS = T.StructType(
    [
        T.StructField(RUN_FOLDER, T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("review_dt", T.DateType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rated", T.LongType()),
        T.StructField("stars", T.LongType()),
        T.StructField("positives", T.LongType()),
    ]
)


def _held(spark: SparkSession, path: str) -> list[str]:
    """Folders with rows that the table holds now."""
    rows = snapshot(read_commits(spark, path)).where("rows > 0").select("folder")
    return sorted(row["folder"] for row in rows.collect())


def refresh_rollups(spark: SparkSession, path: str) -> list[str]:
    """Roll up the committed folders that have no parts yet, and return them.

    All of them are read in one scan, without their texts. Their parts become visible together, so a
    job that breaks off leaves nothing, and the next one takes the same folders again.
    """
    target = f"{path}/{ROLLUPS}"
    done = {row["run"] for row in read_commits(spark, target).select("run").collect()}
    missing = [folder for folder in _held(spark, path) if folder not in done]
    if not missing:
        return []
    schema = T.StructType([*STORED_REVIEW.fields, T.StructField(RUN_FOLDER, T.StringType())])
    reviews = spark.read.schema(schema).option("basePath", path).parquet(
        *[f"{path}/{folder}" for folder in missing]
    )
    version = newest_version(spark, target) + 1
    parts = category_days(silver_reviews(reviews), RUN_FOLDER)
    parts.write.mode("overwrite").parquet(f"{target}/{version}")
    commit(spark, target, [(version, folder, f"{version}", 1, []) for folder in missing])
    return missing


def stored_category_days(spark: SparkSession, path: str) -> DataFrame:
    """``category_days`` of the whole table from the parts of the folders that it holds now.

    Folders that came after the last refresh are rolled up first.
    """
    refresh_rollups(spark, path)
    target = f"{path}/{ROLLUPS}"
    held = _held(spark, path)
    records = read_commits(spark, target).where(F.col("run").isin(held)).select("folder").distinct()
    folders = sorted(f"{target}/{row['folder']}" for row in records.collect())
    if not folders:
        return spark.createDataFrame([], PARTS).drop(RUN_FOLDER)
    names = [folder.removeprefix(f"{RUN_FOLDER}=") for folder in held]
    parts = spark.read.schema(PARTS).parquet(*folders).where(F.col(RUN_FOLDER).isin(names))
    sums = [F.sum(name).alias(name) for name in ("rows", "rated", "stars", "positives")]
    return parts.groupBy("product_category", "review_dt").agg(*sums)
