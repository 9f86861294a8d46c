"""Text features as vectors, trained models and their comparison.

Fitting is iterative, so most of these queries have no SQL to check against; tests check them
otherwise. All of them use whole tables. A single family is fitted with the fast settings; the search
over all grids has the folds and model sizes of a full run, and the queries about it share one run.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.catalog.common import spread_features, whole
from reviewmill.catalog.oracle_views import REVIEWS_TO_FEATURES, TOKENS
from reviewmill.catalog.scoring_queries import STOP_LIST
from reviewmill.operators.features import scaling_input
from reviewmill.operators.layout import spread_over_cores
from reviewmill.operators.splits import split_by_time
from reviewmill.plans.baseline import fit_baseline, score_baseline
from reviewmill.plans.scaling import fit_counted, light_counts
from reviewmill.plans.train_job import baseline_model
from reviewmill.plans.training import (
    FAMILIES,
    FAST,
    FULL,
    STAT_COLUMNS,
    best_by_metric,
    comparison,
    fit_families,
    fitted_stages,
    grid_search,
    measure,
    scored,
    stored_predictions,
    text_stages,
    whole_table,
)
from reviewmill.session import shared_folder, written
from reviewmill.sinks.tables import write_table
from reviewmill.sources.tables import read_predictions

PROFILE = whole_table(FAST)
# Models of the search are fitted on every training row; all newer rows are scored.
SEARCH = grid_search()


def hashing_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of each document's hashed counts, which is its number of tokens, and the vector's length."""
    rows = PipelineModel(text_stages(PROFILE.hash_buckets)).transform(spread_features(spark, sf_dir))
    tf = F.unwrap_udt("tf")
    return rows.select(
        "review_id",
        F.aggregate(tf["values"], F.lit(0.0), lambda total, n: total + n).cast("int").alias("tokens"),
        _length("tf").alias("buckets"),
    )


def _length(vector: str) -> Column:
    """The length of each vector from its own values; a sparse one is not turned into an array."""
    fields = F.unwrap_udt(vector)
    return F.coalesce(fields["size"], F.size(fields["values"]))


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each assembled vector and the values after the term weights."""
    rows = PipelineModel(text_stages(PROFILE.hash_buckets)).transform(spread_features(spark, sf_dir))
    vectors = Pipeline(stages=fitted_stages()).fit(rows).transform(rows)
    names = [*STAT_COLUMNS, "category_name_len", "category_idx"]
    values = vector_to_array("features")
    return vectors.where("features IS NOT NULL").select(
        "review_id", _length("features").alias("dimensions"),
        *[F.round(F.get(values, F.lit(PROFILE.hash_buckets + i)), 9).alias(name)
          for i, name in enumerate(names)],
    )


def predictions_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored predictions of a model that was fitted on a sample: all newest rows are there.

    Probabilities add up to one, and the prediction is the class of the larger margin.
    """
    rows = spread_features(spark, sf_dir)
    run = fit_families(rows, replace(PROFILE, sample_fraction=FULL.sample_fraction), ["logreg"])
    folder = shared_folder(spark, "predictions")
    write_table(stored_predictions(run.models[0].predictions), folder)
    run.release()
    total = F.get("probability", F.lit(0)) + F.get("probability", F.lit(1))
    larger = F.get("rawPrediction", F.lit(1)) > F.get("rawPrediction", F.lit(0))
    return read_predictions(spark, folder).select(
        "review_id", "label",
        F.size("probability").alias("probabilities"), F.size("rawPrediction").alias("margins"),
        F.round(total, 9).alias("total_probability"),
        (larger == (F.col("prediction") == 1.0)).alias("agrees"),
    )


def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline with all its stages, saved and loaded: how many rows it scores differently."""
    rows = spread_features(spark, sf_dir)
    run = fit_families(rows, PROFILE, ["logreg"])
    folder = shared_folder(spark, "model")
    run.models[0].pipeline.write().overwrite().save(folder)
    run.release()
    _, _, test = split_by_time(rows)
    both = [
        model.transform(test).select("review_id", "prediction", vector_to_array("probability").alias("p"))
        for model in (run.models[0].pipeline, PipelineModel.load(folder))
    ]
    one, two = both[0], both[1].toDF("review_id", "again", "q")
    same = (F.col("prediction") == F.col("again")) & (F.col("p") == F.col("q"))
    return one.join(two, "review_id").agg(
        F.count("*").alias("rows"), F.count_if(~same).alias("differing")
    )


def _one_row(spark: SparkSession, metrics: dict[str, float]) -> DataFrame:
    return spark.range(1).select(*[F.lit(value).alias(name) for name, value in metrics.items()])


def _family(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spread_features(spark, sf_dir)
        run = fit_families(rows, PROFILE, [name])
        table = comparison(rows, run.models)
        run.release()
        return table

    return query


@dataclass(frozen=True)
class Search:
    """Stored results of one search over all families and grids, on the same rows."""

    grid: DataFrame
    metrics: DataFrame
    best: str
    predictions: DataFrame


_SEARCHES: dict[tuple[str, str], Search] = {}


def _search(spark: SparkSession, sf_dir: str) -> Search:
    """The search of this application over a folder's tables; run once, its results are written."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SEARCHES:
        rows = spread_features(spark, sf_dir)
        run = fit_families(rows, SEARCH)
        points = [(m.name, point, auc) for m in run.models for point, auc in m.cv_auc]
        grid = spark.createDataFrame(points, "model string, params string, mean_auc double")
        table = comparison(rows, [*run.models, baseline_model(rows, PROFILE)])
        best = best_by_metric(table, families=FAMILIES).first().model
        scores = scored(next(m.predictions for m in run.models if m.name == best))
        _SEARCHES[key] = Search(
            written(grid, "search-grid"), written(table, "search-metrics"), best,
            written(scores, "search-predictions"),
        )
        run.release()
    return _SEARCHES[key]


def cv_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean AUC of every grid point of every family."""
    return _search(spark, sf_dir).grid


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three families and the baseline on the same test rows."""
    return _search(spark, sf_dir).metrics


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_by_metric(_search(spark, sf_dir).metrics, families=FAMILIES)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the newest reviews from the best family by test AUC."""
    return _search(spark, sf_dir).predictions


def model_ngram_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, test = split_by_time(spread_features(spark, sf_dir))
    return _one_row(spark, measure(score_baseline(fit_baseline(train), test)))


def model_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the light model and report how well it separates the rows it was fitted on."""
    rows = scaling_input(spread_over_cores(whole(spark, sf_dir)))
    counted = light_counts(rows)
    metrics = measure(fit_counted(counted).transform(counted))
    counted.unpersist()
    return _one_row(spark, metrics)


QUERIES = {
    "hashing_tf": hashing_tf,
    "feature_vectors": feature_vectors,
    **{f"model_{name}": _family(name) for name in FAMILIES},
    "cv_results": cv_results,
    "model_metrics": model_metrics,
    "best_model": best_model,
    "predictions": predictions,
    "predictions_stored": predictions_stored,
    "model_reload": model_reload,
    "model_ngram_baseline": model_ngram_baseline,
    "model_light": model_light,
}

ORACLES = {
    "hashing_tf": f"""{REVIEWS_TO_FEATURES}, {TOKENS}
SELECT review_id, CAST(len(list_filter(tokens, lambda t: t NOT IN ({STOP_LIST}))) AS INTEGER)
  AS tokens, 4096 AS buckets FROM tokenised""",
    "feature_vectors": f"""{REVIEWS_TO_FEATURES},
counts AS (SELECT product_category, count(*) AS n FROM features GROUP BY 1),
places AS (SELECT product_category,
  row_number() OVER (ORDER BY n DESC, product_category) - 1 AS place FROM counts)
SELECT review_id, 4102 AS dimensions,
  len(string_split_regex(review_text, '[ \\t\\n\\x0b\\f\\r]+'))::DOUBLE AS txt_token_count,
  length(review_text)::DOUBLE AS txt_char_count,
  (length(review_text) - length(replace(review_text, '!', '')))::DOUBLE AS txt_exclaim_count,
  round(length(regexp_replace(review_text, '[^A-Z]', '', 'g'))::DOUBLE / length(review_text), 9)
    AS txt_upper_ratio,
  category_name_len::DOUBLE AS category_name_len, place::DOUBLE AS category_idx
FROM features JOIN places USING (product_category)""",
    "predictions_stored": f"""{REVIEWS_TO_FEATURES}
SELECT review_id, lab AS label, 2 AS probabilities, 2 AS margins, 1.0::DOUBLE AS total_probability,
  true AS agrees FROM features
WHERE unix_time > (SELECT quantile_disc(unix_time, 0.85) FROM features)""",
    "model_reload": f"""{REVIEWS_TO_FEATURES}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM features
WHERE unix_time > (SELECT quantile_disc(unix_time, 0.85) FROM features)""",
}
