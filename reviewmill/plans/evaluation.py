"""Evaluation of stored predictions: AUC, F1, accuracy interval and expected profit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.draws import DEFAULT_SEED
from reviewmill.operators.bootstrap import ITERATIONS, row_interval
from reviewmill.operators.scoring import (
    COST_FN,
    COST_FP,
    PROFIT_TP,
    area_under_roc,
    confusion,
    expected_profit,
    f1_weighted,
)
from reviewmill.sinks.tables import write_json
from reviewmill.sources.tables import read_predictions

NOTES = "Scores come from rows newer than all training rows."


def scored_from_store(predictions: DataFrame) -> DataFrame:
    """The columns the metrics need; the score is the raw prediction of the positive class."""
    return predictions.select(
        "review_id", "label", "prediction", F.get("rawPrediction", F.lit(1)).alias("score")
    )


def evaluation_summary(
    scored: DataFrame,
    iterations: int = ITERATIONS,
    tp_profit: float = PROFIT_TP,
    fp_cost: float = COST_FP,
    fn_cost: float = COST_FN,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """One row with all results; each metric is a scalar subquery over its own small aggregate."""
    auc = area_under_roc(scored).scalar()
    interval = row_interval(scored, iterations=iterations, seed=seed)
    profit = F.struct(
        expected_profit(tp_profit, fp_cost, fn_cost).alias("expected_profit"), "tp", "fp", "fn"
    )
    return confusion(scored).select(
        auc.alias("auc"),
        f1_weighted().alias("f1"),
        interval.select(F.struct("low", "high")).scalar().alias("bootstrap_accuracy_ci"),
        profit.alias("business_metrics"),
        F.lit(NOTES).alias("notes"),
    )


def run_evaluation(spark: SparkSession, predictions_path: str, out: str, **options) -> dict:
    """Evaluate stored predictions, write the result, and return it."""
    summary = evaluation_summary(
        scored_from_store(read_predictions(spark, predictions_path)), **options
    )
    write_json(summary, out)
    return spark.read.schema(summary.schema).json(out).first().asDict(recursive=True)
