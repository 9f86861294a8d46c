"""Expressions on review fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIS_PER_DAY = 86_400_000
SECONDS_PER_DAY = 86_400
# 0001-01-01 and 9999-12-31 as days since 1970-01-01.
FIRST_DAY, LAST_DAY = -719_162, 2_932_896

# Prefix of a feed name, name of an unnamed feed, text for an absent id part,
# shape of a review date, lowest and highest rating, lowest rating that counts as positive.
FEED_PREFIX = "raw_review_"
UNKNOWN_FEED = "unknown"
ABSENT_ID_PART = "na"
DATE_SHAPE = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
DATE_PATTERN = "yyyy-M-d"
MIN_STARS, MAX_STARS, POSITIVE_STARS = 1, 5, 4


def utc_day_text(epoch_millis: Column) -> Column:
    """UTC day of an epoch in milliseconds as yyyy-MM-dd, without using the session time zone.

    Null if the day is not in the years 1 to 9999, as with an epoch in another unit.
    """
    day = F.floor(epoch_millis.cast("decimal(20,0)") / MILLIS_PER_DAY).try_cast("int")
    dated = F.when(day.between(FIRST_DAY, LAST_DAY), day)
    return F.date_from_unix_date(dated).cast("string")


def category_of_feed(feed: Column) -> Column:
    return F.regexp_replace(F.coalesce(feed, F.lit(UNKNOWN_FEED)), f"^{FEED_PREFIX}", "")


def joined_id(*parts: Column) -> Column:
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit(ABSENT_ID_PART)) for p in parts])


def yes_no_text(flag: Column) -> Column:
    """True / False as text; null stays null."""
    return F.initcap(flag.cast("string"))


def whole_stars(stars: Column) -> Column:
    """A rating as an integer: fractions are cut off, text that is no integer gives null."""
    return stars.try_cast("int")


def parsed_date(day: Column) -> Column:
    """Date of a year-month-day text; null for other shapes and for days that do not exist."""
    return F.when(day.rlike(DATE_SHAPE), F.try_to_date(day, DATE_PATTERN))


def unix_seconds(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * SECONDS_PER_DAY


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def title_and_body(title: str, body: str) -> Column:
    return F.concat_ws(" ", blank_if_null(F.col(title)), blank_if_null(F.col(body)))


def is_positive(stars: Column) -> Column:
    """1 for a rating of at least four, else 0; a null rating counts as 0."""
    return F.when(stars >= POSITIVE_STARS, 1).otherwise(0)


def binary_label(stars: Column) -> Column:
    return is_positive(stars).cast("double")
