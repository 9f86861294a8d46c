"""Batch ingest: normalise, validate, store valid rows by month, log rejects, report metrics."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators.normalise import keyed_reviews, mixed_reviews, raw_reviews
from reviewmill.operators.ordering import first_rows
from reviewmill.operators.validation import rejected_reviews, valid_reviews
from reviewmill.schemas import REVIEW_COLUMNS
from reviewmill.session import remove_folder, shared_folder
from reviewmill.sinks.tables import run_path, write_bronze, write_json, write_log

NORMALISERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "keyed": keyed_reviews,
    "raw": raw_reviews,
    "mixed": mixed_reviews,
}


@dataclass(frozen=True)
class IngestTarget:
    bronze_path: str
    rejects_path: str
    metrics_path: str


@dataclass(frozen=True)
class Lineage:
    """Where a feed came from, kept with its metrics."""

    dataset: str
    dataset_config: str
    split: str = "full"
    streaming: bool = False
    git_commit: str = "unknown"


def normalise(records: DataFrame, shape: str) -> DataFrame:
    return NORMALISERS[shape](records)


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    """Normalised feeds, for instance one per language, as one table."""
    return reduce(lambda left, right: left.unionByName(right), feeds)


POSITION = "_position"


def position() -> Column:
    """Place of a review in the order of a digest of the whole row.

    A distributed scan has no arrival order, so the digest stands in for it. It covers the whole row
    and not just its id, because an id may belong to any number of rows.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in REVIEW_COLUMNS]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def capped(valid: DataFrame, max_rows: int) -> DataFrame:
    """The first valid rows in the order of ``position``; all of them for 0."""
    if max_rows <= 0:
        return valid
    return first_rows(valid.withColumn(POSITION, position()), max_rows, POSITION).drop(POSITION)


def rejects_in_scope(reviews: DataFrame, kept: DataFrame, max_rows: int) -> DataFrame:
    """The rejects that stand before the last valid row that a capped run keeps."""
    if max_rows <= 0 or kept.count() < max_rows:
        return rejected_reviews(reviews)
    last = kept.agg(F.max(position())).first()[0]
    return rejected_reviews(reviews.where(position() <= last))


def ingest_metrics(
    spark: SparkSession, rows_written: int, lineage: Lineage, target: IngestTarget
) -> DataFrame:
    """One row: the lineage, the number of rows written, and the paths."""
    values = {
        **vars(lineage),
        "rows_written": rows_written,
        "bronze_path": target.bronze_path,
        "audit_log": target.rejects_path,
    }
    return spark.range(1).select(*[F.lit(value).alias(name) for name, value in values.items()])


def run_ingest(
    records: DataFrame,
    shape: str,
    target: IngestTarget,
    lineage: Lineage,
    max_rows: int = 0,
    run: str | None = None,
) -> int:
    """Ingest one feed and return the number of rows written.

    The feed is parsed once, into a columnar table from which valid rows and rejects are two scans,
    and which is deleted when both are stored. Each run has a folder of its own in every log and
    table; a run that is given a name replaces what an earlier run of that name has left.
    """
    spark = records.sparkSession
    run = run or uuid.uuid4().hex
    parsed = shared_folder(spark, "normalised")
    rows = normalise(records, shape)
    rows.write.parquet(parsed)
    reviews = spark.read.schema(rows.schema).parquet(parsed)
    stored = write_bronze(capped(valid_reviews(reviews), max_rows), target.bronze_path, run)
    write_log(rejects_in_scope(reviews, stored, max_rows), target.rejects_path, run)
    count = stored.count()
    write_json(ingest_metrics(spark, count, lineage, target), run_path(target.metrics_path, run))
    remove_folder(spark, parsed)
    return count
