"""Metrics against fixed values, Spark's evaluators and brute force."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from reviewmill.functions.draws import poisson_weight
from reviewmill.operators.bootstrap import (
    accuracy_interval,
    hit_distribution,
    resampled_accuracies,
    row_accuracies,
    row_interval,
)
from reviewmill.operators.dashboards import with_cost
from reviewmill.operators.scoring import (
    accuracy,
    area_under_roc,
    confusion,
    expected_profit,
    f1_binary,
    f1_weighted,
    score_card,
)
from reviewmill.plans.evaluation import evaluation_summary

SCHEMA = "review_id string, label double, prediction double, score double"


def cells_frame(spark, tp, fp, fn, tn):
    pairs = [(1.0, 1.0)] * tp + [(0.0, 1.0)] * fp + [(1.0, 0.0)] * fn + [(0.0, 0.0)] * tn
    rows = [(f"r{i}", label, pred, pred) for i, (label, pred) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


def random_frame(spark, n, seed, digits=1):
    rng = np.random.default_rng(seed)
    scores = np.round(rng.normal(size=n), digits) + 0.0  # turns -0.0 into 0.0
    labels = (rng.random(n) < 1 / (1 + np.exp(-scores))).astype(float)
    rows = [(f"r{i}", float(l), float(s > 0.3), float(s)) for i, (l, s) in enumerate(zip(labels, scores))]
    return spark.createDataFrame(rows, SCHEMA)


def test_recorded_values(spark):
    row = confusion(cells_frame(spark, 180, 27, 14, 17)).select(
        expected_profit().alias("profit"), f1_weighted().alias("f1"),
        f1_binary().alias("f1b"), accuracy().alias("acc"),
    ).first()
    assert row.profit == 485.0
    assert row.acc == pytest.approx(0.8277310924369747)
    assert row.f1 == pytest.approx(0.8155935092241384)
    assert row.f1b == pytest.approx(0.8977556109725686)


def test_recorded_cost(spark):
    rows = [(4, 3.22), (8, 1.86), (16, 2.18), (4, 1.11), (8, 1.6), (16, 1.89)]
    table = with_cost(spark.createDataFrame(rows, "partitions int, train_seconds double"))
    costs = [r.cost_proxy for r in table.collect()]
    assert costs == pytest.approx([12.88, 14.88, 34.88, 4.44, 12.8, 30.24])


@pytest.mark.parametrize("digits", [0, 1, 6])
def test_auc_and_f1_match_the_evaluators(spark, digits):
    scored = random_frame(spark, 400, digits, digits).cache()
    card = score_card(scored).first()
    binary = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert card.auc == pytest.approx(binary.evaluate(scored), abs=1e-12)
    several = MulticlassClassificationEvaluator(metricName="f1")
    assert card.f1_weighted == pytest.approx(several.evaluate(scored), abs=1e-12)
    assert card.accuracy == pytest.approx(
        several.setMetricName("accuracy").evaluate(scored), abs=1e-12
    )


@pytest.mark.parametrize("buckets", [2, 5, 64])
def test_auc_matches_brute_force_for_any_number_of_ranges(spark, buckets):
    scored = random_frame(spark, 200, 7)
    rows = scored.collect()
    pairs = [
        (p.score > n.score) + 0.5 * (p.score == n.score)
        for p in rows if p.label == 1.0 for n in rows if n.label == 0.0
    ]
    assert area_under_roc(scored, buckets).first().auc == pytest.approx(sum(pairs) / len(pairs))


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_auc_of_a_single_class_is_the_evaluators(spark, label):
    rows = [(f"r{i}", label, 1.0, float(i)) for i in range(5)]
    scored = spark.createDataFrame(rows, SCHEMA)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert area_under_roc(scored).first().auc == evaluator.evaluate(scored)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tuple(confusion(empty).select("tp", "fp", "fn", expected_profit()).first()) == (0, 0, 0, 0.0)
    assert tuple(accuracy_interval(empty).first()) == (0.0, 0.0)
    assert confusion(empty).select(accuracy(), f1_weighted()).first()[0] == 0.0


def binomial_upto(n, hits):
    """Chances of at most k hits, with exact fractions."""
    p, total, out = Fraction(hits, n), Fraction(0), []
    for k in range(n + 1):
        total += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        out.append(total)
    return out


@pytest.mark.parametrize("cells", [(30, 5, 3, 22), (1, 0, 0, 0), (0, 3, 2, 0), (400, 0, 0, 1), (1, 900, 0, 0)])
def test_bootstrap_inverts_the_exact_distribution(spark, cells):
    scored = cells_frame(spark, *cells)
    n, hits = sum(cells), cells[0] + cells[3]
    upto = binomial_upto(n, hits)
    expected = []
    for i in range(40):
        draw = Fraction(int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:13], 16), 16**13)
        expected.append(next(k for k, chance in enumerate(upto) if chance > draw) / n)
    found = {r.iteration: r.accuracy for r in resampled_accuracies(scored, 40).collect()}
    assert [found[i] for i in range(40)] == expected
    low, high = np.percentile(expected, [2.5, 97.5])
    assert tuple(accuracy_interval(scored, iterations=40).first()) == pytest.approx((low, high))


def test_hit_distribution_of_a_large_table(spark):
    """Of 10^10 rows only the numbers near the mean are looked at, and their mean and spread fit."""
    n, hits = 10**10, 7 * 10**9
    counts = spark.createDataFrame([(n, hits)], "n long, hits long")
    rows = hit_distribution(counts).orderBy("k").toPandas()
    assert len(rows) < 40 * math.sqrt(n)
    chance = np.diff(rows["upto"], prepend=0.0)
    mean = float((chance * (rows["k"] - hits)).sum())
    assert rows["upto"].iloc[-1] == pytest.approx(1.0) and abs(mean) < 1.0
    spread = float((chance * (rows["k"] - hits - mean) ** 2).sum())
    assert spread == pytest.approx(n * 0.7 * 0.3, rel=1e-4)


def test_bootstrap_interval_is_as_wide_as_resampling(spark):
    scored = cells_frame(spark, 180, 27, 14, 17)
    low, high = accuracy_interval(scored).first()
    rng = np.random.default_rng(1)
    expected = np.percentile(rng.binomial(238, 197 / 238, 20_000) / 238, [2.5, 97.5])
    assert (low, high) == pytest.approx(tuple(expected), abs=0.015)


def test_row_bootstrap_matches_brute_force(spark):
    """Every row is drawn in every resample, with weights that are not cut off."""
    scored = random_frame(spark, 60, 3)
    levels, total = [], Fraction(0)
    for k in range(30):
        total += Fraction(1, math.factorial(k))
        levels.append(float(total) * math.exp(-1.0) * 16**8)
    weights, hits = np.zeros(20), np.zeros(20)
    for row in scored.collect():
        for i in range(20):
            digest = hashlib.sha256(f"42:{i // 8}:{row.review_id}".encode()).hexdigest()
            draw = int(digest[8 * (i % 8): 8 * (i % 8) + 8], 16)
            weight = next(k for k, level in enumerate(levels) if draw < math.floor(level))
            weights[i] += weight
            hits[i] += weight * (row.label == row.prediction)
    found = {r.iteration: r.accuracy for r in row_accuracies(scored, iterations=20).collect()}
    assert [found[i] for i in range(20)] == pytest.approx(list(hits / weights))
    low, high = np.percentile(hits / weights, [2.5, 97.5])
    assert tuple(row_interval(scored, iterations=20).first()) == pytest.approx((low, high))
    summary = evaluation_summary(scored, iterations=20).first().bootstrap_accuracy_ci
    assert (summary.low, summary.high) == pytest.approx((low, high))


def test_bootstrap_weights_are_not_cut_off(spark):
    digits = ["00000000", "ffffd000", "fffffff0", "ffffffff"]
    rows = spark.createDataFrame([(d,) for d in digits], "d string")
    found = [r.w for r in rows.select(poisson_weight(rows.d).alias("w")).collect()]
    assert found[0] == 0 and found[1] < found[2] < found[3] and found[2] > 7


def test_evaluation_summary(spark):
    row = evaluation_summary(cells_frame(spark, 180, 27, 14, 17)).first()
    assert row.business_metrics.expected_profit == 485.0
    assert (row.business_metrics.tp, row.business_metrics.fp, row.business_metrics.fn) == (180, 27, 14)
    assert row.bootstrap_accuracy_ci.low < 0.8277 < row.bootstrap_accuracy_ci.high
    other = evaluation_summary(cells_frame(spark, 2, 1, 1, 0), tp_profit=5.0, fp_cost=2.0, fn_cost=1.0)
    assert other.first().business_metrics.expected_profit == 7.0
