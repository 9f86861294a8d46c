"""Session settings and the shared folder that jobs use for tables they hand on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Names and settings of a session that runs these jobs.
CONF = {
    "spark.driver.maxResultSize": "2g",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
}
PARTITIONS_VARIABLE, PARTITIONS = "SPARK_SHUFFLE_PARTITIONS", "200"


def build_session(app_name: str, extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Start (or fetch) a session with this package's settings; ``extra_conf`` wins over them."""
    shuffle = {"spark.sql.shuffle.partitions": os.environ.get(PARTITIONS_VARIABLE, PARTITIONS)}
    return SparkSession.builder.config(
        map={"spark.app.name": app_name, **CONF, **shuffle, **(extra_conf or {})}
    ).getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Month starts are timestamps, so their day depends on the session time zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder, visible to every executor, for a table one job writes and the next reads.

    The cluster names the root in ``spark.checkpoint.dir``. Only a local session without that
    setting falls back to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        chosen = spark.sparkContext.getCheckpointDir()
        # A checkpoint folder set by a call has the application's own folder at its end.
        root = chosen and chosen.rstrip("/").rpartition("/")[0]
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reviewmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/reviewmill/{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path can be listed, on whatever file system the cluster reads."""
    try:
        spark.read.text(path).schema
        return True
    except AnalysisException:
        return False


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote, with the cluster's own file system client."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(rows: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write a small derived table to the shared folder once and read it from there.

    For tables that a plan uses several times and that are much smaller than their input: the input
    is read once, a lost executor costs no recomputation, and the size of the files tells the
    optimizer and the size checks how large the table really is. Options are those of the writer.
    """
    folder = shared_folder(rows.sparkSession, purpose)
    rows.write.options(**options).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
