"""Hand-written edge rows for the checks on ratings, dates and required fields."""

import pytest
from pyspark.sql import functions as F

from reviewmill.functions.reviews import category_of_feed, parsed_date, utc_day_text, whole_stars
from reviewmill.operators.normalise import keyed_reviews, raw_reviews
from reviewmill.operators.validation import (
    BAD_DATE,
    INVALID,
    MISSING,
    NOT_A_NUMBER,
    OUT_OF_RANGE,
    rejected_reviews,
    valid_reviews,
)
from reviewmill.schemas import KEYED_FEED, RAW_FEED, REVIEW_COLUMNS

GOOD = {
    "review_id": "r", "product_id": "p", "reviewer_id": "u", "stars": "4", "review_body": "fine",
    "review_title": "t", "language": "en", "product_category": "c", "review_date": "2024-01-03",
    "verified_purchase": "True", "vine": None,
}


def feed(spark, **changes):
    row = {**GOOD, **changes}
    return spark.createDataFrame([tuple(row[f.name] for f in KEYED_FEED)], KEYED_FEED)


def outcome(spark, **changes):
    reviews = keyed_reviews(feed(spark, **changes))
    valid, rejects = valid_reviews(reviews).collect(), rejected_reviews(reviews).collect()
    assert len(valid) + len(rejects) == 1
    return valid[0] if valid else rejects[0]


@pytest.mark.parametrize("field", ["review_body", "review_date", "language", "review_id"])
@pytest.mark.parametrize("value", [None, ""])
def test_missing_field(spark, field, value):
    reject = outcome(spark, **{field: value})
    assert (reject.reason, reject.fields, reject.error) == (MISSING, [field], None)


def test_missing_fields_keep_their_order_and_win_over_bad_values(spark):
    reject = outcome(spark, product_category="", review_body=None, stars="9")
    assert (reject.reason, reject.fields) == (MISSING, ["review_body", "product_category"])


@pytest.mark.parametrize(
    "stars, error",
    [("0", OUT_OF_RANGE), ("6", OUT_OF_RANGE), ("4.7", NOT_A_NUMBER), ("many", NOT_A_NUMBER)],
)
def test_bad_stars(spark, stars, error):
    reject = outcome(spark, stars=stars)
    assert (reject.reason, reject.fields, reject.error) == (INVALID, None, error)


@pytest.mark.parametrize("stars, kept", [("1", 1), ("5", 5), (" 5 ", 5)])
def test_good_stars(spark, stars, kept):
    assert outcome(spark, stars=stars).stars == kept


@pytest.mark.parametrize(
    "rating, expected",
    [(5.9, 5), (0.9, 0), (4.0, 4), (float("nan"), None), (-0.5, 0), (None, None)],
)
def test_ratings_are_cut_off(spark, rating, expected):
    row = spark.createDataFrame([(rating,)], "rating double")
    assert row.select(whole_stars(F.col("rating"))).first()[0] == expected


@pytest.mark.parametrize("day", ["2024-02-31", "2024-01-03x", "2024/01/03", "0000-01-01",
                                 "2024-001-3", "24-1-3", "2024-13-01", "-2024-01-01", "x"])
def test_bad_date(spark, day):
    reject = outcome(spark, review_date=day)
    assert (reject.reason, reject.error) == (INVALID, BAD_DATE)


@pytest.mark.parametrize("day", ["2024-1-3", "2024-01-03", "2024-02-29"])
def test_good_date(spark, day):
    assert outcome(spark, review_date=day).review_date == day
    row = spark.createDataFrame([(day,)], "d string").select(parsed_date(F.col("d"))).first()
    assert row[0].isoformat() in {"2024-01-03", "2024-02-29"}


def test_valid_columns_are_in_their_fixed_order(spark):
    assert valid_reviews(keyed_reviews(feed(spark))).columns == REVIEW_COLUMNS


def test_absent_columns_of_keyed_records_are_null(spark):
    records = feed(spark).drop("vine", "language")
    reject = rejected_reviews(keyed_reviews(records)).first()
    assert reject.fields == ["language"]


def test_raw_record(spark):
    rows = [("u1", "a1", 1704240000123, 5.0, "body", None, False), (None, None, None, None, None, None, None)]
    full, empty = raw_reviews(
        spark.createDataFrame(rows, RAW_FEED).withColumn("_dataset_config", F.lit("raw_review_Toys"))
    ).collect()
    assert full.review_id == "u1_a1_1704240000123"
    assert (full.review_date, full.product_category) == ("2024-01-03", "Toys")
    assert (full.verified_purchase, full.language, full.vine) == ("False", "en", None)
    assert empty.review_id == "na_na_na"
    assert (empty.review_date, empty.verified_purchase) == (None, None)


@pytest.mark.parametrize(
    "feed_name, category",
    [("raw_review_Toys", "Toys"), ("Toys", "Toys"), (None, "unknown"),
     ("raw_review_raw_review_x", "raw_review_x"), ("my_raw_review_x", "my_raw_review_x")],
)
def test_category_prefix_is_removed_once(spark, feed_name, category):
    row = spark.createDataFrame([(feed_name,)], "f string")
    assert row.select(category_of_feed(F.col("f"))).first()[0] == category


@pytest.mark.parametrize(
    "millis, day",
    [(0, "1970-01-01"), (-1, "1969-12-31"), (86_399_999, "1970-01-01"), (86_400_000, "1970-01-02"),
     (1_709_251_199_999, "2024-02-29"), (None, None)],
)
@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_utc_day_ignores_the_session_zone(spark, millis, day, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.createDataFrame([(millis,)], "t bigint")
        assert row.select(utc_day_text(F.col("t"))).first()[0] == day
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
