"""Bootstrap confidence interval of the accuracy.

``row_interval`` draws every row's weight in every resample; evaluation and queries use it. Where only
the counts of a table are known, ``accuracy_interval`` does without its rows: a resample draws as many rows as the table has and puts each back, so its number of hits is binomial:
the table's rows need to be counted once and never drawn. Each resample is a uniform draw at which
the exact distribution is inverted.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.draws import DEFAULT_SEED, HEX_DIGITS, poisson_weight, uniform

# Number of resamples and the two percentiles of the interval.
ITERATIONS = 200
LOW_SHARE, HIGH_SHARE = 0.025, 0.975
DRAWS_PER_DIGEST = 8

# Numbers of hits further than this from the mean, in deviations and in hits, have a chance below
# 1e-40 in all, which neither a draw nor a sum of doubles can tell from none.
DEVIATIONS, HITS = 16.0, 160.0


def hit_distribution(counts: DataFrame) -> DataFrame:
    """Each number of hits ``k`` of a resample, with the chance of at most so many.

    ``counts`` has one row (n, hits). A chance is the one before it times a ratio without factorials;
    the logarithms of the ratios add up, and dividing by the sum of all gives the chances. There are
    about thirty times as many numbers as the square root of n, so one task sorts them.
    """
    n, hits = F.col("n").cast("double"), F.col("hits").cast("double")
    mixed = (F.col("hits") > 0) & (F.col("hits") < F.col("n"))
    reach = F.when(mixed, DEVIATIONS * F.sqrt(hits * (1 - hits / n)) + HITS).otherwise(0.0)
    low = F.greatest(F.ceil(hits - reach), F.lit(0).cast("bigint"))
    high = F.least(F.floor(hits + reach), F.col("n"))
    numbers = counts.where("n > 0").select(
        "n", "hits", low.alias("low"), F.explode(F.sequence(low, high)).alias("k")
    )
    ratio = (n - F.col("k") + 1) / F.col("k") * (hits / (n - hits))
    upto = Window.orderBy("k")
    every = Window.partitionBy("n", "hits")
    logs = numbers.withColumn("step", F.when(F.col("k") == F.col("low"), 0.0).otherwise(F.log(ratio)))
    logs = logs.withColumn("log", F.sum("step").over(upto))
    chances = logs.withColumn("chance", F.exp(F.col("log") - F.max("log").over(every)))
    total = F.sum("chance").over(every)
    return chances.select("n", "k", (F.sum("chance").over(upto) / total).alias("upto"))


def resampled_accuracies(
    scored: DataFrame, iterations: int = ITERATIONS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Accuracy of each resample: the least number of hits whose chance passes the draw, over n.

    Rows without a label or prediction are no hits. An empty table has no resamples.
    """
    hit = F.coalesce(F.col("prediction") == F.col("label"), F.lit(False))
    counts = scored.agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
    numbers = hit_distribution(counts)
    drawn = scored.sparkSession.range(iterations).select(
        F.col("id").cast("int").alias("iteration"), uniform(F.col("id"), seed).alias("upto")
    )
    # In one order by chance, the number that a draw falls to is the next one after it.
    both = numbers.withColumn("iteration", F.lit(None).cast("int")).unionByName(
        drawn.withColumn("n", F.lit(None).cast("bigint")).withColumn("k", F.lit(None).cast("bigint"))
    )
    order = Window.orderBy("upto", F.col("iteration").asc_nulls_first())
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    number = F.coalesce(F.first("k", ignorenulls=True).over(after), F.max("k").over(everything))
    share = number.cast("double") / F.max("n").over(everything)
    found = both.select("iteration", share.alias("accuracy"))
    return found.where("iteration IS NOT NULL AND accuracy IS NOT NULL")


def accuracy_interval(
    scored: DataFrame, iterations: int = ITERATIONS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """One row (low, high) from the counts alone; both 0 for an empty table."""
    return _ends(resampled_accuracies(scored, iterations, seed))


def row_accuracies(
    scored: DataFrame, key: str = "review_id", iterations: int = ITERATIONS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Accuracy of each resample, in which every row occurs a Poisson(1) number of times.

    One SHA-256 digest of seed, block and key holds the draws of eight resamples, so a row is
    repeated once per block of eight rather than once per resample. Weights are summed per task
    before the shuffle, which then carries one row per task and block. Rows without a label or
    prediction are no hits.
    """
    blocks = math.ceil(iterations / DRAWS_PER_DIGEST)
    hit = F.coalesce(F.col("prediction") == F.col("label"), F.lit(False)).cast("int")
    rows = scored.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"), hit.alias("_hit"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"),
    )
    digests = rows.withColumn(
        "_digest", F.sha2(F.concat(F.lit(f"{seed}:"), "_block", F.lit(":"), "_key"), 256)
    )
    sums = []
    for i in range(DRAWS_PER_DIGEST):
        weight = poisson_weight(F.substring("_digest", 1 + i * HEX_DIGITS, HEX_DIGITS))
        sums += [F.sum(weight).alias(f"w{i}"), F.sum(weight * F.col("_hit")).alias(f"h{i}")]
    resamples = F.array(
        *[
            F.struct(
                (F.col("_block") * DRAWS_PER_DIGEST + i).alias("iteration"),
                F.col(f"w{i}").alias("weight"),
                F.col(f"h{i}").alias("hits"),
            )
            for i in range(DRAWS_PER_DIGEST)
        ]
    )
    return (
        digests.groupBy("_block").agg(*sums).select(F.inline(resamples))
        .where((F.col("iteration") < iterations) & (F.col("weight") > 0))
        .select("iteration", (F.col("hits").cast("double") / F.col("weight")).alias("accuracy"))
    )


def row_interval(
    scored: DataFrame, key: str = "review_id", iterations: int = ITERATIONS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """One row (low, high) from resamples of all rows; both 0 for an empty table."""
    return _ends(row_accuracies(scored, key, iterations, seed))


def _ends(resamples: DataFrame) -> DataFrame:
    shares = F.array(F.lit(LOW_SHARE), F.lit(HIGH_SHARE))
    ends = resamples.agg(
        F.percentile("accuracy", shares).alias("ends")
    )
    return ends.select(
        F.coalesce(F.get("ends", F.lit(0)), F.lit(0.0)).alias("low"),
        F.coalesce(F.get("ends", F.lit(1)), F.lit(0.0)).alias("high"),
    )
