"""Repeatable pseudo-random draws from row keys.

A draw is a hash of seed and key, so a row gets the same draw in every run, on every executor and
after every retry, and any engine with the same hash function can check it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42
HEX_DIGITS = 8
DRAW_RANGE = 16**HEX_DIGITS
UNIFORM_DIGITS = 13


def hex_threshold(probability: float) -> str:
    """The hex text below which a draw falls with this probability."""
    return format(min(int(probability * DRAW_RANGE), DRAW_RANGE - 1), f"0{HEX_DIGITS}x")


def draw_hex(key: Column, seed: int = DEFAULT_SEED) -> Column:
    """A draw as eight hex digits; texts of equal length compare as the numbers they stand for."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, HEX_DIGITS)


def draw_number(key: Column, seed: int = DEFAULT_SEED) -> Column:
    return F.conv(draw_hex(key, seed), 16, 10).cast("bigint")


def fold_of(key: Column, folds: int, seed: int = DEFAULT_SEED) -> Column:
    return (draw_number(key, seed) % folds).cast("int")


def uniform(key: Column, seed: int = DEFAULT_SEED) -> Column:
    """A draw from 0 up to 1 with 52 random bits, as many as a double holds without rounding."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    return F.conv(F.substring(digest, 1, UNIFORM_DIGITS), 16, 10).cast("double") / F.lit(
        float(16**UNIFORM_DIGITS)
    )


def poisson_thresholds() -> list[str]:
    """Hex texts of the cumulative Poisson(1) probabilities of 0, 1, 2, ...

    They go on until what is left is less than a draw can tell from none, so no weight is cut off.
    """
    total, levels = 0.0, []
    while 1.0 - total >= 1.0 / DRAW_RANGE:
        total += math.exp(-1.0) / math.factorial(len(levels))
        levels.append(hex_threshold(total))
    return levels


def poisson_weight(digits: Column) -> Column:
    """Poisson(1) count of a uniform draw: how often a row occurs in a resample."""
    levels = poisson_thresholds()
    weight = F.when(digits < levels[0], 0)
    for count, level in enumerate(levels[1:], start=1):
        weight = weight.when(digits < level, count)
    return weight.otherwise(len(levels))
