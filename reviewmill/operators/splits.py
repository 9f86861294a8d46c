"""Splits by time: the oldest rows train, the next validate, the newest test."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Shares of the rows that lie before the end of training and of validation.
TRAIN_SHARE, VALID_SHARE = 0.70, 0.85


SHARES = {"train_end": TRAIN_SHARE, "valid_end": VALID_SHARE}


def sketch_size(relative_error: float) -> int:
    """The parameter k of a KLL sketch whose ranks are off by at most this share, 99 times in 100."""
    return min(max(math.ceil((2.446 / relative_error) ** (1 / 0.9433)), 8), 65_535)


def time_sketches(rows: DataFrame, by: list[str], relative_error: float) -> DataFrame:
    """One mergeable sketch of the times of each group, for instance of each month folder.

    A sketch has a bounded size, so sketches can be stored beside the data and merged again whenever
    groups are added, without reading the rows.
    """
    k = sketch_size(relative_error)
    times = rows.where("unix_time IS NOT NULL")
    return times.groupBy(*by).agg(
        F.kll_sketch_agg_bigint("unix_time", k).alias("sketch"), F.count("*").alias("rows")
    )


def cuts_of_sketches(sketches: DataFrame, relative_error: float) -> DataFrame:
    """The two times of ``time_cuts`` from merged sketches; null without rows."""
    merged = sketches.agg(
        F.kll_merge_agg_bigint("sketch", sketch_size(relative_error)).alias("all"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
    )
    return merged.select(
        *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("all", F.lit(share))).alias(name)
          for name, share in SHARES.items()]
    )


def time_cuts(rows: DataFrame, relative_error: float = 0.0) -> DataFrame:
    """One row with the times that end training and validation.

    The exact form counts rows per distinct time before it shuffles. Times are whole days, so there
    are never more of them than days on the calendar. For other time columns give a relative error,
    which bounds the memory instead.
    """
    if relative_error > 0.0:
        return cuts_of_sketches(time_sketches(rows, [], relative_error), relative_error)
    return rows.agg(*[
        F.expr(f"percentile_disc({s}D) WITHIN GROUP (ORDER BY unix_time)").cast("bigint").alias(n)
        for n, s in SHARES.items()
    ])


def with_split(rows: DataFrame, relative_error: float = 0.0) -> DataFrame:
    """Add ``split``: train, valid or test."""
    cuts = time_cuts(rows, relative_error).select(F.struct("*")).scalar()
    return (
        rows.withColumn("_cuts", cuts)
        .withColumn(
            "split",
            F.when(F.col("unix_time") <= F.col("_cuts.train_end"), "train")
            .when(F.col("unix_time") <= F.col("_cuts.valid_end"), "valid")
            .otherwise("test"),
        )
        .drop("_cuts")
    )


def split_by_time(
    rows: DataFrame, relative_error: float = 0.0
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three disjoint tables; the two cut times are fetched once and become plain filters."""
    cuts = time_cuts(rows, relative_error).first()
    time = F.col("unix_time")
    return (
        rows.where(time <= cuts.train_end),
        rows.where((time > cuts.train_end) & (time <= cuts.valid_end)),
        rows.where(time > cuts.valid_end),
    )


def split_sizes(rows_with_split: DataFrame) -> DataFrame:
    return rows_with_split.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.min("review_dt").alias("first_day"),
        F.max("review_dt").alias("last_day"),
    )
