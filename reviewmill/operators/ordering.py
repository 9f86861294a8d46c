"""Running totals over a whole table without sending it through one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import written

BUCKET = "_bucket"
OFFSET = "_offset"


def default_buckets(rows: DataFrame) -> int:
    """As many ranges as the session uses shuffle partitions, so ranges grow with the cluster."""
    return max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_range_bucket(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Number of the value range a row's key falls into; the ranges hold about equally many rows.

    The cut points are computed once, before the plan is built, so every branch of a plan that uses
    the bucket sees the same ranges. Only these few numbers reach the driver.
    """
    fractions = [i / buckets for i in range(1, buckets)]
    cuts = rows.approxQuantile(key, fractions, 1.0 / (4 * buckets))
    inner = sorted(set(cuts))
    if not inner:
        return rows.withColumn(BUCKET, F.lit(0.0))
    splits = [float("-inf"), *inner, float("inf")]
    ranges = Bucketizer(splits=splits, inputCol=key, outputCol=BUCKET, handleInvalid="keep")
    # NaN has a range of its own after the others, and null one after that.
    ranged = ranges.transform(rows)
    return ranged.withColumn(BUCKET, F.coalesce(BUCKET, F.lit(float("inf"))))


def running_total(
    rows: DataFrame,
    key: str,
    value: Column,
    name: str,
    order_by: list[Column] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows up to and including this one.

    ``key`` is the numeric leading sort key. Ranges of it are totalled (one row per range, so the
    totals are bounded by the number of ranges), and each range is then summed on its own. Rows with
    the same key share a range, so callers group equal keys first where these may be many.
    """
    order = order_by or [F.col(key)]
    ranged = with_range_bucket(rows, key, buckets or default_buckets(rows))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(BUCKET)
        .agg(F.sum(value).alias("_total"))
        .select(BUCKET, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias(OFFSET))
    )
    within = (
        Window.partitionBy(BUCKET)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranged.join(F.broadcast(offsets), BUCKET)
        .withColumn(name, F.col(OFFSET) + F.sum(value).over(within))
        .drop(BUCKET, OFFSET)
    )


DIGEST = "_digest"


def first_rows(rows: DataFrame, count: int, key: str) -> DataFrame:
    """The first ``count`` rows by a numeric key, NaN and then null last; all rows for 0.

    Rows per key are counted, and the running total shows the key at which the count is reached. All
    rows before it are kept by a plain filter, so no task sorts or holds them. Of the rows with that
    very key some are kept by the digest of the whole row, in the same way, and of copies of one row
    as many as are wanted.
    """
    if count <= 0:
        return rows
    cut = _cut(rows, count, key)
    if cut is None:
        return rows
    placed = rows.where(cut.at).withColumn(DIGEST, F.xxhash64(*rows.columns))
    inner = _cut(placed, cut.wanted, DIGEST)
    if inner is None:
        return rows.where(cut.before).unionByName(placed.drop(DIGEST))
    # Rows with one digest are copies of one row, so that row is repeated in parallel.
    copy = placed.where(inner.at).drop(DIGEST).limit(1).select(F.struct("*")).scalar()
    copies = rows.sparkSession.range(inner.wanted).select(copy.alias("row")).select("row.*")
    earlier = placed.where(inner.before).drop(DIGEST)
    return rows.where(cut.before).unionByName(earlier).unionByName(copies)


@dataclass(frozen=True)
class Cut:
    """The rows before a key, the rows with that key, and how many of the latter are wanted."""

    before: Column
    at: Column
    wanted: int


def _cut(rows: DataFrame, count: int, key: str) -> Cut | None:
    """The key at which ``count`` rows are reached; None if there are not that many rows."""
    value, order = F.col(key), F.col(key).asc_nulls_last()
    per_key = written(rows.groupBy(key).agg(F.count("*").alias("_rows")), "keys")
    placed = running_total(per_key, key, F.col("_rows"), "_upto", [order])
    last = placed.where(F.col("_upto") >= count).orderBy(order).first()
    if last is None:
        return None
    wanted, found = count - (last["_upto"] - last["_rows"]), last[key]
    if found is None:
        return Cut(value.isNotNull(), value.isNull(), wanted)
    # NaN is the largest value and equals itself.
    literal = F.lit(found).cast(rows.schema[key].dataType)
    return Cut(value < literal, value == literal, wanted)
