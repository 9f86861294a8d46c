"""Samples and folds by row key."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.draws import DEFAULT_SEED, draw_hex, fold_of, hex_threshold

# Fractions from this one on shrink to the fast fraction when a run has to be fast.
FAST_FROM, FAST_FRACTION = 0.01, 0.005


def hash_sample(
    rows: DataFrame, fraction: float, key: str = "review_id", seed: int = DEFAULT_SEED
) -> DataFrame:
    """Keep each row with the given probability, decided by its key alone.

    The same row is kept in every run, and a smaller sample is always part of a larger one.
    """
    if fraction >= 1.0:
        return rows
    return rows.where(draw_hex(F.col(key), seed) < hex_threshold(fraction))


def at_most(
    rows: DataFrame, count: int, stratum: str, key: str = "review_id", seed: int = DEFAULT_SEED
) -> DataFrame:
    """About ``count`` rows, and no more, with each value of ``stratum`` in its share of all rows.

    For a column of few values, such as a label. The rows of a value are drawn by their keys, so the
    sample repeats; each value's draw aims three deviations below its share.
    """
    sizes = {row[stratum]: row["count"] for row in rows.groupBy(stratum).count().collect()}
    total = sum(sizes.values())
    if total <= count:
        return rows
    keep = F.lit(False)
    for value, size in sizes.items():
        wanted = count * size / total
        fraction = max(0.0, wanted - 3 * math.sqrt(wanted)) / size
        chosen = draw_hex(F.col(key), seed) < hex_threshold(fraction)
        keep = F.when(F.col(stratum).eqNullSafe(F.lit(value)), chosen).otherwise(keep)
    return rows.where(keep)


def run_fraction(fraction: float, fast: bool) -> float:
    return FAST_FRACTION if fast and fraction >= FAST_FROM else fraction


def growing_fractions(base: float, steps: int) -> list[float]:
    """Base fraction times 1, 2, 3, ..., never above the whole table."""
    return [min(base * step, 1.0) for step in range(1, steps + 1)]


def with_fold(
    rows: DataFrame, folds: int, key: str = "review_id", seed: int = DEFAULT_SEED
) -> DataFrame:
    return rows.withColumn("fold", fold_of(F.col(key), folds, seed))
