"""Metrics of scored rows (label, prediction, score), each from pre-aggregated counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.ordering import running_total
from reviewmill.session import written

# Worth of a true positive, cost of a false positive and of a false negative.
PROFIT_TP, COST_FP, COST_FN = 3.0, 1.0, 2.0

WIDE = "decimal(38,0)"


def confusion(scored: DataFrame) -> DataFrame:
    """Counts tp, fp, fn, tn in one pass; all 0 for an empty table."""
    actual, predicted = F.col("label") == 1.0, F.col("prediction") == 1.0
    no, not_predicted = F.col("label") == 0.0, F.col("prediction") == 0.0
    return scored.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(no & predicted).alias("fp"),
        F.count_if(actual & not_predicted).alias("fn"),
        F.count_if(no & not_predicted).alias("tn"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def _f1(hits: Column) -> Column:
    return _ratio(2 * hits, 2 * hits + F.col("fp") + F.col("fn"))


def f1_binary() -> Column:
    """F1 of the positive class, from the four counts."""
    return _f1(F.col("tp"))


def f1_weighted() -> Column:
    """F1 of both classes, weighted by their numbers of labels."""
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    weighted = _f1(F.col("tp")) * positives + _f1(F.col("tn")) * negatives
    return _ratio(weighted, positives + negatives)


def accuracy() -> Column:
    hits = F.col("tp") + F.col("tn")
    return _ratio(hits, hits + F.col("fp") + F.col("fn"))


def expected_profit(
    tp_profit: float = PROFIT_TP, fp_cost: float = COST_FP, fn_cost: float = COST_FN
) -> Column:
    return F.col("tp") * F.lit(tp_profit) - F.col("fp") * fp_cost - F.col("fn") * fn_cost


def area_under_roc(scored: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row with the exact area under the ROC curve; ties count half.

    Equal scores are merged before anything is sorted. A positive row's area is the number of
    negatives below its score plus half of those at its score, so a running total of negatives over
    the distinct scores suffices. As in Spark's evaluator, the area is 1 without negatives and 0
    without positives. Counts are multiplied as decimals because they pass 64 bits.
    """
    positive = F.col("label") > 0.5
    per_score = scored.groupBy("score").agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    per_score = written(per_score, "scores")
    ranked = running_total(per_score, "score", F.col("negatives"), "upto", buckets=buckets)
    twice_below = 2 * F.col("upto") - F.col("negatives")
    totals = ranked.agg(
        F.sum(F.col("positives").cast("decimal(19,0)") * twice_below.cast("decimal(19,0)")).alias(
            "area"
        ),
        F.sum("positives").cast("double").alias("p"),
        F.sum("negatives").cast("double").alias("n"),
    )
    area = F.col("area").cast("double") / (2.0 * F.col("p") * F.col("n"))
    return totals.select(
        F.when(F.col("p") == 0, 0.0).when(F.col("n") == 0, 1.0).otherwise(area).alias("auc")
    )


def score_card(scored: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row: AUC, both F1s, accuracy and the four counts."""
    auc = area_under_roc(scored, buckets).scalar()
    return confusion(scored).select(
        auc.alias("auc"),
        f1_weighted().alias("f1_weighted"),
        f1_binary().alias("f1_binary"),
        accuracy().alias("accuracy"),
        "tp",
        "fp",
        "fn",
        "tn",
    )
