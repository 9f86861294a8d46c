"""How training time changes with partitions and with data."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, SQLTransformer
from pyspark.sql import DataFrame

from reviewmill.operators.dashboards import with_cost
from reviewmill.operators.features import scaling_input
from reviewmill.operators.layout import spread
from reviewmill.operators.sampling import growing_fractions, hash_sample
from reviewmill.plans.training import text_stages

# Size and iterations of the light model, partitions and sample of the experiments.
LIGHT_BUCKETS, LIGHT_ITERATIONS = 2**16, 20
PARTITIONS, BASE_FRACTION = (4, 8, 16), 0.05


def light_stages() -> PipelineModel:
    """The stages of the light model that need no fitting, from rows (text, label) to term counts.

    Tokens and counts are made by the stages that all models share; they read ``review_text``.
    """
    named = SQLTransformer(statement="SELECT *, text AS review_text FROM __THIS__")
    return PipelineModel([named, *text_stages(LIGHT_BUCKETS)[:3]])


def light_counts(rows: DataFrame) -> DataFrame:
    """Labels and term counts, kept on disk: every step of a fit and its scores read these.

    Texts are taken apart once and not for the weights, the summary, the solver and the scores each.
    The solver's own blocks need the memory.
    """
    counted = light_stages().transform(rows).select("label", "tf")
    return counted.persist(StorageLevel.DISK_ONLY)


def fit_counted(counted: DataFrame) -> PipelineModel:
    """Logistic regression on weighted term counts, without a grid."""
    weights = IDF(inputCol="tf", outputCol="features")
    return Pipeline(stages=[weights, LogisticRegression(maxIter=LIGHT_ITERATIONS)]).fit(counted)


def fit_light(rows: DataFrame) -> PipelineModel:
    """The light model of rows (text, label), with all its stages."""
    counted = light_counts(rows)
    fitted = fit_counted(counted)
    counted.unpersist()
    return PipelineModel([*light_stages().stages, *fitted.stages])


def _timed_fit(rows: DataFrame) -> float:
    """Seconds of one fit on rows that are in the cache already."""
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    rows.count()
    start = time.time()
    fit_light(rows)
    seconds = round(time.time() - start, 2)
    rows.unpersist()
    return seconds


def run_scaling(
    reviews: DataFrame,
    partitions: Iterable[int] = PARTITIONS,
    base_fraction: float = BASE_FRACTION,
) -> DataFrame:
    """Strong scaling (same sample) and weak scaling (growing sample) over partition counts."""
    counts = list(partitions)

    def sample(fraction: float) -> DataFrame:
        return scaling_input(hash_sample(reviews, fraction))

    runs = [("strong", p, base_fraction) for p in counts]
    runs += [("weak", p, f) for p, f in zip(counts, growing_fractions(base_fraction, len(counts)))]
    rows = [(kind, p, f, _timed_fit(spread(sample(f), p))) for kind, p, f in runs]
    schema = "experiment string, partitions int, fraction double, train_seconds double"
    return with_cost(reviews.sparkSession.createDataFrame(rows, schema))
