"""Partition columns, clustering before a write, and even spreading of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.reviews import parsed_date
from reviewmill.schemas import PARTITION_COLUMNS


def with_month_partitions(reviews: DataFrame) -> DataFrame:
    day = parsed_date(F.col("review_date"))
    return reviews.withColumns({"review_year": F.year(day), "review_month": F.month(day)})


def clustered_for_write(reviews: DataFrame) -> DataFrame:
    """Bring the rows of a month folder together, but split a folder that is too big for a task.

    A plain hash repartition would give a month that holds a third of all rows to one task. The
    rebalance hint lets adaptive execution cut such a partition into pieces of the advisory size
    and merge the small ones.
    """
    return reviews.hint("rebalance", *PARTITION_COLUMNS)


def spread(rows: DataFrame, partitions: int) -> DataFrame:
    return rows.repartition(partitions)


def spread_over_cores(scanned: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than cores; a wider scan is left as it is."""
    cores = scanned.sparkSession.sparkContext.defaultParallelism
    return scanned if scanned.rdd.getNumPartitions() >= cores else spread(scanned, cores)


def partition_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("rows_in_partition")
    )
