"""Models end to end: features, cross-validation, saving, scoring, evaluation and export."""

import math
from dataclasses import replace

import numpy as np
import pytest
from conftest import SMALL
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, IDFModel
from pyspark.sql import functions as F

from reviewmill.catalog import model_queries
from reviewmill.catalog.common import features, valid
from reviewmill.plans import dashboards as export
from reviewmill.plans import training
from reviewmill.operators.terms import term_counts, word_hashes
from reviewmill.plans.baseline import fit_baseline, score_baseline, with_grams
from reviewmill.plans.evaluation import run_evaluation
from reviewmill.plans.scaling import fit_light, run_scaling
from reviewmill.plans.train_job import TrainingTarget, run_training
from reviewmill.plans.training import (
    FAST,
    FULL,
    FAMILIES,
    best_by_metric,
    classifier,
    cross_validate,
    fast,
    fit_families,
    fitted_stages,
    scored,
    stored_predictions,
    text_stages,
    training_rows,
    whole_table,
)
from reviewmill.sinks.tables import write_bronze, write_csv
from reviewmill.sources.tables import model_rows, read_model_metrics, read_predictions, read_silver

TINY = replace(whole_table(FAST), hash_buckets=64, logreg_iterations=3, forest_trees=3, svc_iterations=2)


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("job"))
    write_bronze(valid(spark, SMALL), f"{path}/bronze", "all")
    target = TrainingTarget(f"{path}/models", f"{path}/metrics", f"{path}/predictions", f"{path}/silver")
    return path, target, run_training(spark, f"{path}/bronze", target, TINY)


def test_grids(spark):
    sizes = {name: len(classifier(name, FULL)[1]) for name in FAMILIES}
    assert sizes == {"logreg": 4, "random_forest": 2, "linear_svc": 2}
    assert all(len(classifier(name, FAST)[1]) == 1 for name in FAMILIES)
    assert fast(FULL) == FAST
    assert fast(replace(FULL, sample_fraction=0.001)).sample_fraction == 0.001
    points = {tuple(sorted((p.name, v) for p, v in g.items())) for g in classifier("logreg", FULL)[1]}
    assert points == {(("elasticNetParam", e), ("regParam", r)) for e in (0.0, 0.5) for r in (0.01, 0.1)}


def test_all_models_are_compared(spark, job):
    _, target, models = job
    table = {r.model: r for r in model_rows(read_model_metrics(spark, target.metrics_path)).collect()}
    assert list(table) == [*FAMILIES, "ngram_logreg"]
    assert all(0.0 <= r.auc <= 1.0 and 0.0 <= r.accuracy <= 1.0 for r in table.values())
    assert all(len(m.cv_auc) == 1 and m.best_params for m in models[:3])


def test_stored_predictions_are_the_best_familys(spark, job):
    _, target, models = job
    stored = read_predictions(spark, target.predictions_path)
    best = max(models[:3], key=lambda m: m.metrics["auc"])
    rows = stored.collect()
    assert rows and len({r.review_id for r in rows}) == len(rows)
    assert all((r.probability is None) == (best.name == "linear_svc") for r in rows)
    summary = run_evaluation(spark, target.predictions_path, f"{job[0]}/evaluation", iterations=50)
    assert summary["auc"] == pytest.approx(best.metrics["auc"])
    assert summary["f1"] == pytest.approx(best.metrics["f1_weighted"])
    assert 0.0 <= summary["bootstrap_accuracy_ci"]["low"] <= summary["bootstrap_accuracy_ci"]["high"]
    assert summary["business_metrics"]["tp"] == sum(r.label == r.prediction == 1.0 for r in rows)


def test_predictions_without_probability(spark, job):
    svc = next(m for m in job[2] if m.name == "linear_svc")
    stored = stored_predictions(svc.predictions)
    assert stored.where("probability IS NOT NULL").count() == 0
    assert svc.valid_predictions.count() > 0


def test_a_saved_model_scores_the_same(spark, job):
    _, target, models = job
    rows = features(spark, SMALL)
    for model in models[:3]:
        loaded = PipelineModel.load(f"{target.model_dir}/{model.name}")
        assert len(loaded.stages) == 8
        again = {r.review_id: r.score for r in scored(loaded.transform(rows)).collect()}
        for row in scored(model.predictions).collect():
            assert again[row.review_id] == pytest.approx(row.score)


def test_hashing_query_shows_lost_counts(spark, monkeypatch):
    """The query sums the vectors' own counts: a hash that loses repetitions has other sums."""
    whole = {r.review_id: r for r in model_queries.hashing_tf(spark, SMALL).collect()}

    def losing(buckets):
        stages = text_stages(buckets)
        return [s.setBinary(True) if isinstance(s, HashingTF) else s for s in stages]

    monkeypatch.setattr(model_queries, "text_stages", losing)
    lost = {r.review_id: r for r in model_queries.hashing_tf(spark, SMALL).collect()}
    assert whole.keys() == lost.keys() and all(r.buckets == 4096 for r in whole.values())
    assert sum(r.tokens for r in lost.values()) < sum(r.tokens for r in whole.values())


def test_vector_has_hashed_terms_and_six_numbers(spark, job):
    logreg = next(m for m in job[2] if m.name == "logreg")
    assert logreg.pipeline.stages[-1].numFeatures == TINY.hash_buckets + 6


def test_grid_points_share_folds(spark):
    profile = replace(TINY, logreg_reg=(0.01, 10.0), folds=2)
    rows = training_rows(features(spark, SMALL), profile).cache()
    aucs, seconds = cross_validate(rows, ["logreg"], profile)
    assert len(aucs["logreg"]) == 2 and seconds["logreg"] > 0
    assert "review_text" not in rows.columns


def test_bounded_training_rows_are_drawn_by_key(spark):
    """More rows than the bound: they are drawn by their keys, in both labels' shares."""
    rows = features(spark, SMALL)
    profile = replace(TINY, max_train_rows=120)
    every = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    one, two = (training_rows(rows, profile).collect() for _ in range(2))
    assert 0 < len(one) <= 120 < sum(every.values())
    assert {r.review_id for r in one} == {r.review_id for r in two}
    assert {r.label for r in one} == set(every)


def numbered_rows(spark, count):
    """Reviews with ids, times and words by their numbers; there are few different words."""
    texts = "concat('word', id % 7, ' w', id, IF(id % 3 = 0, ' good', ' bad')) AS review_text"
    return spark.range(count).selectExpr(
        "concat('r', id) AS review_id", "CAST(id % 2 AS DOUBLE) AS label", "id AS unix_time",
        "concat('c', id % 3) AS product_category", "2 AS category_name_len", texts,
    )


def test_the_search_fits_on_every_training_row(spark):
    """More rows than any bound of the past: weights of terms and models come from all of them."""
    rows = numbered_rows(spark, 3_000)
    small = replace(
        model_queries.SEARCH, hash_buckets=64, folds=2, logreg_iterations=2, logreg_reg=(0.1,),
        logreg_elastic=(0.0,),
    )
    run = fit_families(rows, small, ["logreg"])
    documents = [s.numDocs for s in run.models[0].pipeline.stages if isinstance(s, IDFModel)]
    assert documents == [run.rows.count()] == [2_100]
    assert run.models[0].pipeline.stages[-1].summary.predictions.count() == 2_100
    assert run.models[0].predictions.count() == 450
    run.release()


def test_folds_are_judged_by_every_score(spark):
    """A fold's AUC is that of all its scores, also where they are more than an evaluator's 1,000 bins."""
    profile = replace(TINY, hash_buckets=512, folds=2, logreg_reg=(0.01,), logreg_iterations=5)
    rows = training_rows(numbered_rows(spark, 6_000), profile).cache()
    aucs, _ = cross_validate(rows, ["logreg"], profile)
    exact = []
    for fold in range(2):
        kept, held = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        estimator, [point] = classifier("logreg", profile)
        learned = Pipeline(stages=fitted_stages()).fit(kept)
        model = estimator.fit(learned.transform(kept).select("label", "features"), point)
        found = scored(model.transform(learned.transform(held))).toPandas()
        assert found.score.nunique() > 1_000
        ranks, positive = found.score.rank(), found.label == 1.0
        wins = ranks[positive].sum() - positive.sum() * (positive.sum() + 1) / 2
        exact.append(wins / (positive.sum() * (~positive).sum()))
    assert aucs["logreg"] == pytest.approx([sum(exact) / 2], abs=1e-9)


def test_partitions_of_a_fit_grow_with_its_rows(spark, monkeypatch):
    """Few rows get few partitions; what a task holds of many is bounded, whatever the cores."""
    assert training.fit_partitions(1_500, 12, 2**12) == 2
    assert training.fit_partitions(2_000_000, 12, 2**12) == 245
    assert training.fit_partitions(2_000_000, 12, 2**18) == 15_625
    rows = features(spark, SMALL)
    monkeypatch.setattr(training, "NUMBERS_PER_PARTITION", 10 * TINY.hash_buckets)
    sizes = training_rows(rows, TINY).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == math.ceil(rows.count() / 10) > spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in sizes) <= 20


def test_light_model_reads_each_text_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def note(text):
        seen.add(1)
        return text

    texts = [(f"good book {i}" if i % 2 else f"bad book {i}", float(i % 2)) for i in range(40)]
    rows = spark.createDataFrame(texts, "text string, label double")
    noted = F.udf(note, "string").asNondeterministic()
    model = fit_light(rows.select(noted("text").alias("text"), "label"))
    assert seen.value == len(texts)
    found = model.transform(rows).select("label", "prediction").collect()
    assert all(r.label == r.prediction for r in found)


def test_best_model_ignores_others_and_breaks_ties_by_name(spark):
    rows = [("linear_svc", 0.7, 0.1), ("logreg", 0.7, 0.2), ("ngram_logreg", 0.9, 0.9)]
    table = spark.createDataFrame(rows, "model string, auc double, valid_auc double")
    assert best_by_metric(table).first().model == "linear_svc"
    assert best_by_metric(table, "valid_auc").first().model == "logreg"


def test_baseline_weights_and_penalty_match_the_formula(spark):
    texts = ["good good book", "bad book", "good story", "bad bad story", "good bad", "book story"]
    labels = [1.0, 0.0, 1.0, 0.0, 1.0, 0.0]
    rows = spark.createDataFrame(list(zip(texts, labels)), "review_text string, label double")
    model = fit_baseline(rows, min_documents=2)
    vocabulary = model.stages[0].vocabulary
    assert set(vocabulary) == {"good", "bad", "book", "story"}
    documents = [t.split() for t in texts]
    weights = [
        math.log((1 + len(texts)) / (1 + sum(term in d for d in documents))) + 1 for term in vocabulary
    ]
    matrix = np.array([[d.count(t) * w for t, w in zip(vocabulary, weights)] for d in documents])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    found = model.transform(with_grams(rows)).select("features").collect()
    assert np.array([r.features.toArray() for r in found]) == pytest.approx(matrix)
    # At the optimum of summed loss plus half the squared weights, the gradient is zero.
    logreg = model.stages[-1]
    beta, y = logreg.coefficients.toArray(), np.array(labels)
    residual = 1 / (1 + np.exp(-(matrix @ beta + logreg.intercept))) - y
    assert matrix.T @ residual + beta == pytest.approx(np.zeros(len(vocabulary)), abs=1e-3)
    assert residual.sum() == pytest.approx(0.0, abs=1e-3)


def test_baseline_counts_from_hashes_are_those_of_the_first_stage(spark):
    """Fit and scores take texts apart once; their vectors are what CountVectorizerModel makes."""
    texts = ["b a b a c", "", "x_1 \u00c9t\u00e9\u0130 \u03a3\u03a3 d9,ab cd", "a-b ab cd ab cd", "\U0001d54f y ab cd\nab", "zz"]
    rows = spark.createDataFrame(
        [(str(i), t, float(i % 2)) for i, t in enumerate(texts)], "review_id string, review_text string, label double"
    )
    model = fit_baseline(rows, min_documents=1, iterations=3)
    expected = {r.review_id: r for r in model.transform(with_grams(rows)).collect()}
    apart = word_hashes(rows, "review_text", "review_id")
    found = {r.review_id: r.counts for r in term_counts(apart, model.stages[0].vocabulary, "review_id").collect()}
    assert found == {i: r.counts for i, r in expected.items()}
    assert any(v.numNonzeros() for v in found.values())
    assert not found["1"].numNonzeros()
    scores = {r.review_id: r for r in score_baseline(model, rows).collect()}
    assert {i: r.probability for i, r in scores.items()} == {i: r.probability for i, r in expected.items()}


def test_dashboard_export(spark, job, tmp_path):
    path, target, _ = job
    scaling = run_scaling(valid(spark, SMALL), partitions=[2], base_fraction=0.5)
    assert [(r.experiment, r.partitions, r.fraction) for r in scaling.collect()] == [
        ("strong", 2, 0.5), ("weak", 2, 0.5)]
    write_csv(scaling, f"{path}/scaling.csv")
    written = export.export_dashboards(
        spark, target.silver_path, target.metrics_path, f"{path}/scaling.csv", str(tmp_path)
    )
    assert len(written) == 5
    read = {p.rsplit("/", 1)[1]: spark.read.option("header", True).csv(p) for p in written}
    rows = read_silver(spark, target.silver_path).count()
    assert int(read[export.DATA_QUALITY].first().rows_total) == rows
    assert read[export.DAILY_VOLUME].agg(F.sum("reviews_count")).first()[0] == rows
    assert read[export.MODEL_PERFORMANCE].count() == 4
    assert read[export.BUSINESS_INSIGHTS].columns == [
        "product_category", "review_day", "reviews", "avg_stars", "positive_rate"]
    without = export.export_dashboards(
        spark, target.silver_path, target.metrics_path, f"{path}/none.csv", str(tmp_path / "b")
    )
    assert len(without) == 4
