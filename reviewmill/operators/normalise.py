"""Bring both record shapes of a feed to the columns of a stored review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.reviews import (
    category_of_feed,
    joined_id,
    utc_day_text,
    whole_stars,
    yes_no_text,
)
from reviewmill.schemas import REVIEW, REVIEW_COLUMNS
from reviewmill.sources.feeds import FEED_COLUMN, ROW_KEY

DEFAULT_LANGUAGE = "en"
# A column that only feeds of mixed shapes have: what is wrong with the record as a whole.
RECORD_ERROR = "record_error"


def _row_key(records: DataFrame) -> Column:
    """A key for the reject table: the feed's own, or else a digest of the whole record."""
    if ROW_KEY in records.columns:
        return F.col(ROW_KEY).cast("string").alias(ROW_KEY)
    return F.md5(F.to_json(F.struct("*"))).alias(ROW_KEY)


def _from_raw(records: DataFrame) -> dict[str, Column]:
    feed = F.col(FEED_COLUMN) if FEED_COLUMN in records.columns else F.lit(None).cast("string")
    return {
        "review_id": joined_id(F.col("user_id"), F.col("asin"), F.col("timestamp")),
        "product_id": F.col("asin"),
        "reviewer_id": F.col("user_id"),
        "stars": F.col("rating"),
        "review_body": F.col("text"),
        "review_title": F.col("title"),
        "language": F.lit(DEFAULT_LANGUAGE),
        "product_category": category_of_feed(feed),
        "review_date": utc_day_text(F.col("timestamp")),
        "verified_purchase": yes_no_text(F.col("verified_purchase")),
        "vine": F.lit(None).cast("string"),
    }


def keyed_reviews(records: DataFrame) -> DataFrame:
    """Records that have a review key are used as they are; columns they lack are null."""
    columns = [
        F.col(f.name) if f.name in records.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in REVIEW.fields
    ]
    return records.select(*columns, _row_key(records))


def raw_reviews(records: DataFrame) -> DataFrame:
    """Records without a key get one from user, product and time; the feed names the category."""
    columns = [value.alias(name) for name, value in _from_raw(records).items()]
    return records.select(*columns, _row_key(records))


def mixed_reviews(records: DataFrame) -> DataFrame:
    """Records of both shapes in one feed, told apart record by record in a single pass.

    What is wrong with a record as a whole goes on to validation.
    """
    raw = _from_raw(records)
    # Keyed ratings are text; cut off a raw rating's fraction before it becomes text too.
    raw["stars"] = whole_stars(raw["stars"]).cast("string")
    keyed = F.col("has_review_id")
    columns = [F.when(keyed, F.col(c)).otherwise(raw[c]).alias(c) for c in REVIEW_COLUMNS]
    errors = [c for c in records.columns if c == RECORD_ERROR]
    return records.select(*columns, _row_key(records), *errors)
