"""Train, cross-validate and compare classifiers of positive reviews."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    StopWordsRemover,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.draws import DEFAULT_SEED
from reviewmill.operators.category_indexer import CategoryIndexer
from reviewmill.operators.sampling import at_most, hash_sample, run_fraction, with_fold
from reviewmill.operators.scoring import accuracy, confusion, f1_binary, f1_weighted
from reviewmill.operators.splits import split_by_time
from reviewmill.operators.text_stats import OUTPUT_PREFIX, STATISTICS, TextStats
from reviewmill.schemas import MODEL_METRICS, MODEL_SCORE

FAMILIES = ["logreg", "random_forest", "linear_svc"]
STAT_COLUMNS = [OUTPUT_PREFIX + name for name in STATISTICS]
# Rows with their vectors that one task sums up in about the time that it takes to start it.
ROWS_PER_PARTITION = 1_000
# Numbers that one task's rows hold in a forest, which keeps one of four bytes per row and feature.
NUMBERS_PER_PARTITION = 2**25
ROW_COLUMNS = ["review_id", "label", "unix_time", "product_category", "category_name_len"]


@dataclass(frozen=True)
class Profile:
    """Sizes and grids of a training run.

    ``max_train_rows`` bounds the rows that models are fitted on, 0 does not; rows that they score are
    never bounded.
    """

    sample_fraction: float
    hash_buckets: int
    folds: int
    parallelism: int
    logreg_iterations: int
    logreg_reg: tuple[float, ...]
    logreg_elastic: tuple[float, ...]
    forest_trees: int
    forest_depths: tuple[int, ...]
    forest_bins: tuple[int, ...]
    svc_iterations: int
    svc_reg: tuple[float, ...]
    seed: int = DEFAULT_SEED
    max_train_rows: int = 0


# The settings of a full run and of a fast run.
FULL = Profile(
    sample_fraction=0.20,
    hash_buckets=2**18,
    folds=3,
    parallelism=2,
    logreg_iterations=50,
    logreg_reg=(0.01, 0.1),
    logreg_elastic=(0.0, 0.5),
    forest_trees=100,
    forest_depths=(8, 12),
    forest_bins=(64,),
    svc_iterations=30,
    svc_reg=(0.01, 0.1),
)
FAST = Profile(
    sample_fraction=0.005,
    hash_buckets=2**12,
    folds=2,
    parallelism=1,
    logreg_iterations=10,
    logreg_reg=(0.05,),
    logreg_elastic=(0.0,),
    forest_trees=20,
    forest_depths=(5,),
    forest_bins=(32,),
    svc_iterations=10,
    svc_reg=(0.1,),
)


def whole_table(profile: Profile) -> Profile:
    """The same settings without sampling, and with folds running side by side."""
    return replace(profile, sample_fraction=1.0, parallelism=max(2, profile.parallelism))


def grid_search(profile: Profile = FULL) -> Profile:
    """The grids, folds and model sizes of a profile over a whole table: every training row is fitted.

    Terms are hashed into as few buckets as in a fast run: a solver's step sends a coefficient per
    bucket around, and a forest keeps four bytes for every row and bucket.
    """
    return replace(
        profile, sample_fraction=1.0, max_train_rows=0, hash_buckets=FAST.hash_buckets
    )


def fast(profile: Profile) -> Profile:
    """A fast run in place of the given one: a smaller sample, at most two folds, small models."""
    return replace(
        FAST,
        sample_fraction=run_fraction(profile.sample_fraction, fast=True),
        folds=min(profile.folds, FAST.folds),
        seed=profile.seed,
    )


def text_stages(hash_buckets: int) -> list:
    """Stages that need no fitting: tokens, stop words, hashed term counts, text statistics."""
    return [
        Tokenizer(inputCol="review_text", outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens", locale="en_US"),
        HashingTF(inputCol="filtered_tokens", outputCol="tf", numFeatures=hash_buckets),
        TextStats(inputCol="review_text", outputPrefix=OUTPUT_PREFIX),
    ]


def fitted_stages() -> list:
    """Stages that learn from the rows they are fitted on, and the assembly of the vector."""
    return [
        IDF(inputCol="tf", outputCol="tfidf"),
        CategoryIndexer(inputCol="product_category", outputCol="product_category_idx"),
        VectorAssembler(
            inputCols=["tfidf", *STAT_COLUMNS, "category_name_len", "product_category_idx"],
            outputCol="features",
        ),
    ]


def classifier(name: str, profile: Profile) -> tuple[Estimator, list[dict]]:
    """A family's estimator and its parameter grid."""
    if name == "logreg":
        logreg = LogisticRegression(maxIter=profile.logreg_iterations)
        grid = ParamGridBuilder().addGrid(logreg.regParam, list(profile.logreg_reg))
        return logreg, grid.addGrid(logreg.elasticNetParam, list(profile.logreg_elastic)).build()
    if name == "random_forest":
        forest = RandomForestClassifier(numTrees=profile.forest_trees, seed=profile.seed)
        grid = ParamGridBuilder().addGrid(forest.maxDepth, list(profile.forest_depths))
        return forest, grid.addGrid(forest.maxBins, list(profile.forest_bins)).build()
    if name == "linear_svc":
        svc = LinearSVC(maxIter=profile.svc_iterations)
        return svc, ParamGridBuilder().addGrid(svc.regParam, list(profile.svc_reg)).build()
    raise ValueError(f"unknown model family: {name}")


def grid_text(point: dict) -> str:
    return ", ".join(f"{param.name}={value}" for param, value in point.items())


def counted_rows(features: DataFrame, profile: Profile) -> DataFrame:
    """Rows with hashed term counts and statistics; the text itself is dropped."""
    counted = PipelineModel(text_stages(profile.hash_buckets)).transform(features)
    return counted.select(*ROW_COLUMNS, "tf", *STAT_COLUMNS)


def training_rows(train: DataFrame, profile: Profile) -> DataFrame:
    """The sampled part of the rows before the first cut, counted, with a fold.

    What needs no fitting is done once here and not again for every fold, family and grid point.
    Few rows come from many scan tasks, so they are spread anew; the scan keeps its width. A solver
    runs a job per step, which for few rows costs more than their sums, so they get no more partitions
    than ``ROWS_PER_PARTITION`` asks for. Many rows get more partitions than cores, so that what a
    task holds stays within ``NUMBERS_PER_PARTITION`` however large the table is.
    """
    drawn = hash_sample(train, profile.sample_fraction, seed=profile.seed)
    if profile.max_train_rows:
        drawn = at_most(drawn, profile.max_train_rows, "label", seed=profile.seed)
    sampled = counted_rows(drawn, profile)
    cores = train.sparkSession.sparkContext.defaultParallelism
    partitions = fit_partitions(drawn.count(), cores, profile.hash_buckets)
    return with_fold(sampled, profile.folds, seed=profile.seed).repartition(partitions)


def fit_partitions(rows: int, cores: int, hash_buckets: int) -> int:
    most = max(1, NUMBERS_PER_PARTITION // hash_buckets)
    return max(1, min(cores, math.ceil(rows / ROWS_PER_PARTITION)), math.ceil(rows / most))


@dataclass
class TrainedModel:
    name: str
    pipeline: PipelineModel
    best_params: str
    cv_auc: list[tuple[str, float]]
    predictions: DataFrame
    valid_predictions: DataFrame
    metrics: dict[str, float] = field(default_factory=dict)


@dataclass
class TrainingRun:
    """Trained models and the cached rows that their predictions are computed from."""

    models: list[TrainedModel]
    rows: DataFrame

    def release(self) -> None:
        """Drop the cached rows, once the predictions are written."""
        self.rows.unpersist()


def scored(predictions: DataFrame) -> DataFrame:
    """Label, prediction and score of each test row; the score is the margin of the positive class."""
    return predictions.select(
        "review_id",
        "label",
        "prediction",
        F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("score"),
    )


def ranking_quality(predictions: DataFrame) -> float:
    """Exact AUC: without bins the evaluator sorts all distinct scores and keeps the whole curve."""
    return BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(predictions)


def measure(predictions: DataFrame) -> dict[str, float]:
    """Exact AUC, both F1s and accuracy of predictions, which are computed once for all of them."""
    rows = predictions.select("label", "prediction", "rawPrediction")
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    cells = confusion(rows).select(
        f1_weighted().alias("f1_weighted"),
        f1_binary().alias("f1_binary"),
        accuracy().alias("accuracy"),
    )
    metrics = {"auc": ranking_quality(rows), **cells.first().asDict()}
    rows.unpersist()
    return metrics


def _validate_fold(
    train: DataFrame, fold: int, families: list[str], profile: Profile
) -> dict[str, tuple[list[float], float]]:
    """Exact AUC of every grid point of every family on one held-out fold, and each family's seconds.

    The fold fits the term weights and the category index on its own training rows, once for all
    families and grid points.
    """
    start = time.time()
    kept, held = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
    features = Pipeline(stages=fitted_stages()).fit(kept)
    kept_vectors = features.transform(kept).select("label", "features")
    held_vectors = features.transform(held).select("label", "features")
    kept_vectors.persist(StorageLevel.MEMORY_AND_DISK)
    held_vectors.persist(StorageLevel.MEMORY_AND_DISK)
    shared = time.time() - start
    results = {}
    for name in families:
        start = time.time()
        estimator, grid = classifier(name, profile)
        aucs = [
            ranking_quality(estimator.fit(kept_vectors, point).transform(held_vectors))
            for point in grid
        ]
        results[name] = (aucs, shared + time.time() - start)
    kept_vectors.unpersist()
    held_vectors.unpersist()
    return results


def cross_validate(
    train: DataFrame, families: list[str], profile: Profile
) -> tuple[dict[str, list[float]], dict[str, float]]:
    """Mean AUC over the folds for every grid point of every family, and each family's seconds.

    The seconds share out the elapsed time by the work each family caused. Up to ``parallelism``
    folds run at a time, so their small jobs share the cluster and no more folds than that are
    cached.
    """
    start = time.time()
    validate = inheritable_thread_target(train.sparkSession)(
        lambda fold: _validate_fold(train, fold, families, profile)
    )
    with ThreadPool(max(1, min(profile.parallelism, profile.folds))) as pool:
        folds = pool.map(validate, range(profile.folds))
    mean_auc = {
        name: [sum(aucs) / profile.folds for aucs in zip(*[fold[name][0] for fold in folds])]
        for name in families
    }
    worked = {name: sum(fold[name][1] for fold in folds) for name in families}
    wall = time.time() - start
    return mean_auc, {name: wall * worked[name] / sum(worked.values()) for name in families}


def fit_families(
    features: DataFrame, profile: Profile, families: list[str] = FAMILIES
) -> TrainingRun:
    """Cross-validate each family, refit its best grid point on the training rows, score the rest.

    ``features`` are all rows of ``review_features``. Time quantiles see all of them, and every row
    after the first cut is scored; only the rows that models are fitted on are sampled. The models
    keep their text stages, so they score such rows directly. A model's seconds include counting
    terms, which all models share.
    """
    started = time.time()
    before, *after = split_by_time(features)
    train = training_rows(before, profile).persist(StorageLevel.MEMORY_AND_DISK)
    valid, test = (counted_rows(part, profile) for part in after)
    train.count()
    counting = time.time() - started
    cv_auc, seconds = cross_validate(train, families, profile)

    start = time.time()
    learned = Pipeline(stages=fitted_stages()).fit(train)
    columns = ["review_id", "label", "features"]
    train_vectors = learned.transform(train).select(*columns)
    train_vectors.persist(StorageLevel.MEMORY_AND_DISK)
    valid_vectors, test_vectors = (learned.transform(p).select(*columns) for p in (valid, test))
    shared = counting + time.time() - start

    trained = []
    for name in families:
        start = time.time()
        estimator, grid = classifier(name, profile)
        best = max(range(len(grid)), key=lambda i: cv_auc[name][i])
        model: Model = estimator.fit(train_vectors, grid[best])
        predictions = model.transform(test_vectors)
        metrics = measure(predictions)
        metrics["train_seconds"] = round(seconds[name] + shared + time.time() - start, 2)
        valid_predictions = model.transform(valid_vectors)
        metrics["valid_auc"] = ranking_quality(valid_predictions)
        pipeline = PipelineModel([*text_stages(profile.hash_buckets), *learned.stages, model])
        trained.append(
            TrainedModel(
                name=name,
                pipeline=pipeline,
                best_params=grid_text(grid[best]),
                cv_auc=[(grid_text(p), auc) for p, auc in zip(grid, cv_auc[name])],
                predictions=predictions.drop("features"),
                valid_predictions=valid_predictions.drop("features"),
                metrics=metrics,
            )
        )
    train_vectors.unpersist()
    return TrainingRun(trained, train)


def comparison(features: DataFrame, models: list[TrainedModel]) -> DataFrame:
    """One row per model with its test metrics."""
    names = [f.name for f in MODEL_SCORE.fields if f.name != "model"]
    rows = [(m.name, *[float(m.metrics[n]) for n in names]) for m in models]
    return features.sparkSession.createDataFrame(rows, MODEL_SCORE)


def metrics_record(
    features: DataFrame, models: list[TrainedModel], profile: Profile
) -> DataFrame:
    """The comparison as one nested record with the run's settings."""
    rows = comparison(features, models).agg(F.collect_list(F.struct("*")).alias("models"))
    now = datetime.now(timezone.utc).isoformat()
    settings = rows.select(
        F.lit(now).alias("timestamp_utc"),
        F.lit(profile.sample_fraction).alias("sample_fraction"),
        F.lit(profile.folds).alias("cv_folds"),
        F.lit(profile.parallelism).alias("cv_parallelism"),
        "models",
    )
    return settings.select(*[F.col(f.name).cast(f.dataType) for f in MODEL_METRICS.fields])


def best_by_metric(table: DataFrame, metric: str = "auc", families: list[str] = FAMILIES) -> DataFrame:
    """The row of the best family; models outside the families do not compete.

    ``auc`` picks by the test rows; ``valid_auc`` picks by the rows before them, which keeps the
    test rows out of the choice.
    """
    return (
        table.where(F.col("model").isin(families)).orderBy(F.desc(metric), "model").limit(1)
    )


def stored_predictions(predictions: DataFrame) -> DataFrame:
    """Prediction rows as stored: vectors as arrays, and no probability where the model has none."""
    has_probability = "probability" in predictions.columns
    probability = (
        vector_to_array("probability") if has_probability else F.lit(None).cast("array<double>")
    )
    return predictions.select(
        "review_id",
        "label",
        "prediction",
        probability.alias("probability"),
        vector_to_array("rawPrediction").alias("rawPrediction"),
    )
