"""Tables that several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.operators.features import review_features, silver_reviews
from reviewmill.operators.layout import spread_over_cores
from reviewmill.operators.normalise import keyed_reviews
from reviewmill.operators.validation import typed, valid_reviews
from reviewmill.session import use_utc
from reviewmill.sources.examples import document_reviews, patchy_reviews, whole_reviews


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_reviews(document_reviews(use_utc(spark), sf_dir))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What validation leaves of the feed with defects."""
    return valid_reviews(reviews(spark, sf_dir))


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review of every document, none of them lost to a planted defect."""
    return valid_reviews(keyed_reviews(whole_reviews(use_utc(spark), sf_dir)))


def patchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with gaps, as they would come from a table that was not validated."""
    return typed(keyed_reviews(patchy_reviews(use_utc(spark), sf_dir)))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_reviews(whole(spark, sf_dir))


def spread_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features for work on the text, where a single file would keep most cores idle."""
    return review_features(spread_over_cores(whole(spark, sf_dir)))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_features(whole(spark, sf_dir))
