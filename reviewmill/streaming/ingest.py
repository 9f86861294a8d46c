"""Streaming ingest: the batch ingest's operators, applied to each micro-batch of new files.

The checkpoint remembers which files belong to which batch. Each batch replaces its own folders, so
a batch that runs again after a failure neither loses nor doubles rows. The folders carry the
stream's name, because batch numbers start at 0 with every checkpoint.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewmill.operators.ordering import running_total
from reviewmill.operators.validation import is_valid, rejected_reviews, valid_reviews
from reviewmill.plans.ingest import normalise
from reviewmill.schemas import BATCH_AUDIT, REJECT
from reviewmill.sinks.commits import RUN_FOLDER
from reviewmill.sinks.tables import write_bronze, write_log


@dataclass(frozen=True)
class StreamTarget:
    bronze_path: str
    rejects_path: str
    audit_path: str
    checkpoint_path: str

    @property
    def stream(self) -> str:
        """A name that stays the same for a checkpoint and differs between checkpoints."""
        return hashlib.md5(self.checkpoint_path.rstrip("/").encode()).hexdigest()[:12]

    def run(self, batch: int) -> str:
        return f"{self.stream}-{batch}"


def write_batch(reviews: DataFrame, batch: int, target: StreamTarget) -> None:
    """Store one micro-batch; its input is read once and kept while three outputs are made."""
    reviews = reviews.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        valid = is_valid(reviews)
        audit = reviews.agg(
            F.lit(target.stream).alias("stream"),
            F.lit(batch).cast("bigint").alias("batch"),
            F.count_if(valid).alias("rows"),
            F.count_if(~valid).alias("rejected"),
        )
        run = target.run(batch)
        write_bronze(valid_reviews(reviews), target.bronze_path, run)
        write_log(rejected_reviews(reviews), target.rejects_path, run)
        write_log(audit, target.audit_path, run)
    finally:
        reviews.unpersist()


def start_ingest(records: DataFrame, shape: str, target: StreamTarget) -> StreamingQuery:
    """Ingest all files that have arrived, in micro-batches, then stop."""
    return (
        normalise(records, shape)
        .writeStream.foreachBatch(lambda rows, batch: write_batch(rows, batch, target))
        .option("checkpointLocation", target.checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REJECT).json(path).drop(RUN_FOLDER)


def read_batch_audit(spark: SparkSession, path: str) -> DataFrame:
    """The batch log with a running total of the rows written, by batch and then by stream."""
    batches = spark.read.schema(BATCH_AUDIT).json(path).drop(RUN_FOLDER)
    order = [F.col("batch"), F.col("stream")]
    return running_total(batches, "batch", F.col("rows"), "total_written", order)
