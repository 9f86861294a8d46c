"""Metrics of scored rows and term statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.catalog.common import spread_features, whole
from reviewmill.catalog.oracle_views import (
    ACCURACY,
    AUC,
    CELLS,
    F1_BINARY,
    F1_WEIGHTED,
    REVIEWS_TO_FEATURES,
    SCORED,
    TOKENS,
    WORD_BREAK,
)
from reviewmill.functions.text import STOP_WORDS, space_tokens, without_stop_words
from reviewmill.operators import terms
from reviewmill.operators.bootstrap import row_interval
from reviewmill.operators.scoring import (
    accuracy,
    area_under_roc,
    confusion,
    expected_profit,
    f1_binary,
    f1_weighted,
)
from reviewmill.plans.evaluation import evaluation_summary
from reviewmill.session import use_utc
from reviewmill.sources.examples import scored_documents

DIGITS = 9


def _rounded(value, name: str):
    return F.round(value, DIGITS).alias(name)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_documents(use_utc(spark), sf_dir)


def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(_scored(spark, sf_dir))


def eval_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = confusion(_scored(spark, sf_dir))
    return cells.select(expected_profit().alias("expected_profit"), "tp", "fp", "fn")


def eval_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area_under_roc(_scored(spark, sf_dir)).select(_rounded("auc", "auc"))


def eval_f1_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(_scored(spark, sf_dir)).select(_rounded(f1_weighted(), "f1"))


def eval_f1_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(_scored(spark, sf_dir)).select(_rounded(f1_binary(), "f1"))


def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(_scored(spark, sf_dir)).select(_rounded(accuracy(), "accuracy"))


def eval_bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    interval = row_interval(_scored(spark, sf_dir))
    return interval.select(_rounded("low", "low"), _rounded("high", "high"))


def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = evaluation_summary(_scored(spark, sf_dir))
    return summary.select(
        _rounded("auc", "auc"),
        _rounded("f1", "f1"),
        _rounded("bootstrap_accuracy_ci.low", "low"),
        _rounded("bootstrap_accuracy_ci.high", "high"),
        "business_metrics.expected_profit",
        "business_metrics.tp",
        "business_metrics.fp",
        "business_metrics.fn",
    )


def tok_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = space_tokens(F.col("review_text"))
    return spread_features(spark, sf_dir).select(
        "review_id", F.size(tokens).alias("tokens"), F.md5(F.array_join(tokens, "|")).alias("digest")
    )


def stopword_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread_features(spark, sf_dir).select(
        "review_id", without_stop_words(space_tokens(F.col("review_text"))).alias("kept")
    )
    return rows.select(
        "review_id", F.size("kept").alias("tokens"), F.md5(F.array_join("kept", "|")).alias("digest")
    )


def term_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_frequencies(spread_features(spark, sf_dir), "review_id", "review_text")


def idf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    idf = terms.inverse_document_frequencies(spread_features(spark, sf_dir), "review_text")
    return idf.select("term", "doc_freq", _rounded("idf", "idf"))


def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = terms.tf_idf(spread_features(spark, sf_dir), "review_id", "review_text")
    return weights.select("review_id", "term", "tf", _rounded("tfidf", "tfidf"))


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.category_index(whole(spark, sf_dir))


def ngram_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.gram_vocabulary(spread_features(spark, sf_dir), "review_text")


QUERIES = {
    "eval_confusion": eval_confusion,
    "eval_profit": eval_profit,
    "eval_auc": eval_auc,
    "eval_f1_weighted": eval_f1_weighted,
    "eval_f1_binary": eval_f1_binary,
    "eval_accuracy": eval_accuracy,
    "eval_bootstrap_ci": eval_bootstrap_ci,
    "eval_summary": eval_summary,
    "tok_counts": tok_counts,
    "stopword_removed": stopword_removed,
    "term_freq": term_freq,
    "idf_terms": idf_terms,
    "tfidf_terms": tfidf_terms,
    "category_index": category_index,
    "ngram_vocab": ngram_vocab,
}

_CELLS = f"WITH {SCORED}, {CELLS}"
_PROFIT = "3.0::DOUBLE * tp - fp - 2 * fn"
STOP_LIST = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)
# Every row in 200 resamples, with a Poisson(1) weight from eight hex digits of a digest. The levels
# are the probabilities of at most 0, 1, 2, ... occurrences, as far as eight digits tell them apart.
_INTERVAL = """
draws AS (
  SELECT i AS iteration, coalesce(prediction = lab, false)::INTEGER AS hit,
    substr(sha256('42:' || (i // 8) || ':' || review_id), CAST(1 + 8 * (i % 8) AS BIGINT), 8) AS draw
  FROM scored, range(200) AS steps(i)),
weights AS (
  SELECT iteration, hit, (draw >= '5e2d58d8')::INTEGER + (draw >= 'bc5ab1b1')::INTEGER + (draw >= 'eb715e1d')::INTEGER +
    (draw >= 'fb239797')::INTEGER + (draw >= 'ff1025f5')::INTEGER + (draw >= 'ffd90f3b')::INTEGER +
    (draw >= 'fffa8b71')::INTEGER + (draw >= 'ffff540c')::INTEGER + (draw >= 'ffffed1f')::INTEGER +
    (draw >= 'fffffe21')::INTEGER + (draw >= 'ffffffd4')::INTEGER + (draw >= 'fffffffc')::INTEGER +
    (draw >= 'ffffffff')::INTEGER AS weight FROM draws),
resamples AS (
  SELECT iteration, sum(hit * weight)::DOUBLE / sum(weight) AS accuracy
  FROM weights GROUP BY iteration),
ends AS (
  SELECT quantile_cont(accuracy, 0.025) AS low, quantile_cont(accuracy, 0.975) AS high
  FROM resamples)"""
_TERMS = f"""{REVIEWS_TO_FEATURES}, {TOKENS},
occurrences AS (SELECT review_id, unnest(tokens) AS term FROM tokenised),
tf AS (SELECT review_id, term, count(*) AS tf FROM occurrences
  WHERE term NOT IN ({STOP_LIST}) GROUP BY 1, 2),
idf AS (SELECT term, count(*) AS doc_freq,
  ln(((SELECT count(*) FROM features) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS idf
  FROM tf GROUP BY 1)"""

ORACLES = {
    "eval_confusion": f"{_CELLS} SELECT tp, fp, fn, tn FROM cells",
    "eval_profit": f"{_CELLS} SELECT {_PROFIT} AS expected_profit, tp, fp, fn FROM cells",
    "eval_auc": f"WITH {SCORED}, {AUC} SELECT round(auc, {DIGITS}) AS auc FROM auc",
    "eval_f1_weighted": f"{_CELLS} SELECT round({F1_WEIGHTED}, {DIGITS}) AS f1 FROM cells",
    "eval_f1_binary": f"{_CELLS} SELECT round({F1_BINARY}, {DIGITS}) AS f1 FROM cells",
    "eval_accuracy": f"{_CELLS} SELECT round({ACCURACY}, {DIGITS}) AS accuracy FROM cells",
    "eval_bootstrap_ci": f"""WITH {SCORED}, {_INTERVAL}
SELECT round(low, {DIGITS}) AS low, round(high, {DIGITS}) AS high FROM ends""",
    "eval_summary": f"""{_CELLS}, {AUC}, {_INTERVAL}
SELECT round(auc, {DIGITS}) AS auc, round({F1_WEIGHTED}, {DIGITS}) AS f1,
  round(low, {DIGITS}) AS low, round(high, {DIGITS}) AS high,
  {_PROFIT} AS expected_profit, tp, fp, fn FROM cells, auc, ends""",
    "tok_counts": f"""{REVIEWS_TO_FEATURES}, {TOKENS}
SELECT review_id, CAST(len(tokens) AS INTEGER) AS tokens,
  md5(array_to_string(tokens, '|')) AS digest FROM tokenised""",
    "stopword_removed": f"""{REVIEWS_TO_FEATURES}, {TOKENS},
kept AS (SELECT review_id, list_filter(tokens, lambda t: t NOT IN ({STOP_LIST})) AS kept
  FROM tokenised)
SELECT review_id, CAST(len(kept) AS INTEGER) AS tokens,
  md5(array_to_string(kept, '|')) AS digest FROM kept""",
    "term_freq": f"{_TERMS} SELECT review_id, term, tf FROM tf",
    "idf_terms": f"{_TERMS} SELECT term, doc_freq, round(idf, {DIGITS}) AS idf FROM idf",
    "tfidf_terms": f"""{_TERMS}
SELECT review_id, term, tf, round(tf * idf, {DIGITS}) AS tfidf FROM tf JOIN idf USING (term)""",
    "category_index": f"""{REVIEWS_TO_FEATURES},
counts AS (SELECT product_category, count(*) AS reviews FROM valid
  WHERE product_category IS NOT NULL GROUP BY 1)
SELECT product_category, reviews, CAST(row_number() OVER (
  ORDER BY reviews DESC, product_category) - 1 AS INTEGER) AS category_idx FROM counts""",
    "ngram_vocab": f"""{REVIEWS_TO_FEATURES},
word_lists AS (SELECT review_id, list_filter(
  string_split_regex(lower(review_text), '{WORD_BREAK}'), lambda w: length(w) >= 2) AS words
  FROM features),
grams AS (
  SELECT review_id, unnest(words) AS term FROM word_lists
  UNION ALL
  SELECT review_id, unnest(list_transform(range(1, len(words)),
    lambda i: words[i] || ' ' || words[i + 1])) FROM word_lists),
counts AS (SELECT term, count(*) AS total, count(DISTINCT review_id) AS doc_freq
  FROM grams GROUP BY 1)
SELECT term, total, doc_freq FROM counts WHERE doc_freq >= 5
ORDER BY total DESC, term LIMIT 50000""",
}
