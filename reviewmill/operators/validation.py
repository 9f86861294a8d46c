"""Split normalised reviews into valid rows and rejects with reasons.

Valid and rejected rows are two filters on the same scan. The filter for valid rows is a plain
conjunction, so null and blank checks reach the file reader; the reject side reads only the
required columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions.reviews import MAX_STARS, MIN_STARS, parsed_date, whole_stars
from reviewmill.operators.normalise import RECORD_ERROR
from reviewmill.schemas import REQUIRED, REVIEW
from reviewmill.sources.feeds import ROW_KEY

# Reasons in the reject table.
MISSING = "missing_required"
INVALID = "validation_error"
OUT_OF_RANGE = "stars_out_of_range"
NOT_A_NUMBER = "stars_not_an_integer"
BAD_DATE = "review_date_invalid"


def present(reviews: DataFrame, name: str) -> Column:
    """Not null and, for text, not empty."""
    value = F.col(name)
    if isinstance(reviews.schema[name].dataType, T.StringType):
        return value.isNotNull() & (value != "")
    return value.isNotNull()


def _all_present(reviews: DataFrame) -> Column:
    return reduce(Column.__and__, [present(reviews, name) for name in REQUIRED])


def stars_in_range() -> Column:
    return F.coalesce(whole_stars(F.col("stars")).between(MIN_STARS, MAX_STARS), F.lit(False))


def date_is_valid() -> Column:
    return parsed_date(F.col("review_date")).isNotNull()


def record_error(reviews: DataFrame) -> Column:
    """What is wrong with a record before its fields are looked at; null if nothing is."""
    return F.col(RECORD_ERROR) if RECORD_ERROR in reviews.columns else F.lit(None).cast("string")


def is_valid(reviews: DataFrame) -> Column:
    valid = _all_present(reviews) & stars_in_range() & date_is_valid()
    return valid & F.col(RECORD_ERROR).isNull() if RECORD_ERROR in reviews.columns else valid


def missing_fields(reviews: DataFrame) -> Column:
    """Names of the missing required fields in their fixed order."""
    names = [F.when(~present(reviews, name), F.lit(name)) for name in REQUIRED]
    return F.split(F.concat_ws(",", *names), ",")


def reject_reason(reviews: DataFrame) -> Column:
    """A broken record comes first, then missing fields, so a row has one reason; null if valid."""
    return (
        F.when(record_error(reviews).isNotNull(), INVALID)
        .when(~_all_present(reviews), MISSING)
        .when(~(stars_in_range() & date_is_valid()), INVALID)
    )


def reject_error(reviews: DataFrame) -> Column:
    return (
        F.when(record_error(reviews).isNotNull(), record_error(reviews))
        .when(whole_stars(F.col("stars")).isNull(), NOT_A_NUMBER)
        .when(~stars_in_range(), OUT_OF_RANGE)
        .otherwise(BAD_DATE)
    )


def typed(reviews: DataFrame) -> DataFrame:
    """The columns of a stored review in their fixed order and types."""
    columns = [
        whole_stars(F.col("stars")).alias("stars")
        if f.name == "stars"
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in REVIEW.fields
    ]
    return reviews.select(*columns)


def valid_reviews(reviews: DataFrame) -> DataFrame:
    return typed(reviews.where(is_valid(reviews)))


def rejected_reviews(reviews: DataFrame) -> DataFrame:
    """One row per rejected record: its key, the reason, and what is missing or wrong."""
    reason = reject_reason(reviews)
    none = F.lit(None)
    return reviews.where(~is_valid(reviews)).select(
        ROW_KEY,
        reason.alias("reason"),
        F.when(reason == MISSING, missing_fields(reviews)).otherwise(none).alias("fields"),
        F.when(reason == INVALID, reject_error(reviews)).otherwise(none).alias("error"),
    )


def reject_summary(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count("*").alias("rejects"))
