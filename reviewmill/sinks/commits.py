"""A log of committed runs, which decides what a reader of a stored table sees.

A run writes its data first and then one small record, whose file appears by a single rename. The
record names the folder that holds the run's rows and the folders it takes the place of. Folders that
no record names are not part of the table: a run that broke off leaves nothing that is read, a run
that is repeated keeps its old rows until the new ones are complete, and files that were merged are
exchanged for the merged one at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.session import path_exists

RUN_FOLDER = "ingest_run"
# Names with an underscore in front are passed over by readers of the data.
LOG = "_commits"
COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("run", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("replaces", T.ArrayType(T.StringType())),
    ]
)


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """All records of a table, with the newest version of each run and those it replaced."""
    log = f"{path}/{LOG}"
    if not path_exists(spark, log):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(log)


def snapshot(commits: DataFrame) -> DataFrame:
    """The records whose folders are the table now: the newest of each run, unless replaced."""
    newest = Window.partitionBy("run").orderBy(F.desc("version"), F.desc("folder"))
    replaced = commits.select(F.explode("replaces").alias("folder")).distinct()
    return (
        commits.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")
        .join(replaced, "folder", "left_anti")
    )


def newest_version(spark: SparkSession, path: str) -> int:
    """The highest version of the log, 0 without one."""
    return read_commits(spark, path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def next_place(spark: SparkSession, path: str, run: str) -> tuple[int, str]:
    """The version of the next record, and a folder for the run that no record names.

    A run's first folder carries its name alone. Data without a record may lie there, left by a try
    that broke off; it is overwritten. A run whose rows were merged with others cannot be repeated.
    """
    version = newest_version(spark, path) + 1
    commits = read_commits(spark, path)
    own = commits.where(F.col("run") == run).select("folder")
    if not own.take(1):
        return version, f"{RUN_FOLDER}={run}"
    merged = commits.select(F.explode("replaces").alias("folder"))
    if merged.join(own, "folder", "left_semi").take(1):
        raise ValueError(f"the rows of run {run} were merged with those of others")
    return version, f"{RUN_FOLDER}={run}~{version}"


def commit(
    spark: SparkSession, path: str, records: list[tuple[int, str, str, int, list[str]]]
) -> None:
    """Add the records (version, run, folder, rows, replaces) that make folders part of the table.

    They are one small file, which its writer renames into the log when it is complete.
    """
    spark.createDataFrame(records, COMMIT).coalesce(1).write.mode("append").json(f"{path}/{LOG}")


def snapshot_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders to read; as many as there are runs since files were last merged."""
    held = snapshot(read_commits(spark, path)).where("rows > 0").orderBy("version", "folder")
    return [f"{path}/{row['folder']}" for row in held.select("folder").collect()]


def unreferenced(spark: SparkSession, path: str) -> list[str]:
    """Folders that records name and the table no longer holds; no new reader needs them."""
    commits = read_commits(spark, path)
    gone = commits.select("folder").join(snapshot(commits).select("folder"), "folder", "left_anti")
    return [f"{path}/{row['folder']}" for row in gone.distinct().orderBy("folder").collect()]
