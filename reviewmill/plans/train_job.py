"""The training job from stored reviews to models, metrics, predictions and the silver table."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reviewmill.operators.features import review_features, silver_reviews
from reviewmill.operators.sampling import hash_sample
from reviewmill.operators.splits import split_by_time
from reviewmill.plans.baseline import fit_baseline, score_baseline
from reviewmill.plans.training import (
    Profile,
    TrainedModel,
    best_by_metric,
    comparison,
    fit_families,
    measure,
    metrics_record,
    ranking_quality,
    stored_predictions,
)
from reviewmill.sinks.tables import write_json, write_table
from reviewmill.sources.tables import read_bronze


@dataclass(frozen=True)
class TrainingTarget:
    model_dir: str
    metrics_path: str
    predictions_path: str
    silver_path: str


def baseline_model(features: DataFrame, profile: Profile) -> TrainedModel:
    """The n-gram baseline, fitted on the same sample as the families and scored on all other rows."""
    before, valid, test = split_by_time(features)
    train = hash_sample(before, profile.sample_fraction, seed=profile.seed)
    start = time.time()
    model = fit_baseline(train)
    predictions = score_baseline(model, test)
    metrics: dict[str, float] = measure(predictions)
    metrics["train_seconds"] = round(time.time() - start, 2)
    valid_predictions = score_baseline(model, valid)
    metrics["valid_auc"] = ranking_quality(valid_predictions)
    return TrainedModel(
        "ngram_logreg", model, "", [], predictions, valid_predictions, metrics
    )


def run_training(
    spark: SparkSession, bronze_path: str, target: TrainingTarget, profile: Profile
) -> list[TrainedModel]:
    """Train and store everything; the best family's predictions are the ones that are kept."""
    bronze = read_bronze(spark, bronze_path)
    features = review_features(bronze)
    run = fit_families(features, profile)
    for model in run.models:
        model.pipeline.write().overwrite().save(f"{target.model_dir}/{model.name}")
    every = [*run.models, baseline_model(features, profile)]
    write_json(metrics_record(features, every, profile), target.metrics_path)
    best = best_by_metric(comparison(features, run.models)).first().model
    predictions = next(m.predictions for m in run.models if m.name == best)
    write_table(stored_predictions(predictions), target.predictions_path)
    run.release()
    write_table(silver_reviews(bronze), target.silver_path)
    return every
