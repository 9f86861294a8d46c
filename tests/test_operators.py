"""Ordering, joins, samples, splits and layout."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewmill.operators.features import category_dimension, join_category, review_features, scaling_input
from reviewmill.operators.joins import hot_key_join, lookup_join, salted_join
from reviewmill.operators.layout import partition_sizes, spread, spread_over_cores
from reviewmill.operators.normalise import keyed_reviews
from reviewmill.operators.ordering import first_rows, running_total
from reviewmill.operators.sampling import at_most, growing_fractions, hash_sample, run_fraction, with_fold
from reviewmill.operators.splits import (
    cuts_of_sketches,
    split_by_time,
    time_cuts,
    time_sketches,
    with_split,
)
from reviewmill.plans.ingest import capped


@pytest.mark.parametrize("buckets", [2, 3, 50])
def test_running_total_matches_brute_force(spark, buckets):
    values = [(i * 37 % 101, i % 7) for i in range(101)]
    rows = spark.createDataFrame(values, "k bigint, v bigint")
    found = running_total(rows, "k", F.col("v"), "total", buckets=buckets).orderBy("k").collect()
    total = 0
    for (key, value), row in zip(sorted(values), found):
        total += value
        assert (row.k, row.v, row.total) == (key, value, total)


def test_running_total_of_equal_keys_and_of_nothing(spark):
    rows = spark.createDataFrame([(1, i) for i in range(5)], "k bigint, v bigint")
    found = running_total(rows, "k", F.col("v"), "total", [F.col("k"), F.col("v")]).collect()
    assert sorted(r.total for r in found) == [0, 1, 3, 6, 10]
    assert running_total(rows.where("k > 1"), "k", F.col("v"), "total").count() == 0


def test_first_rows_by_a_unique_key(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert sorted(r.k for r in first_rows(rows, 123, "k").collect()) == list(range(123))
    assert first_rows(rows, 0, "k").count() == 1000


def test_first_rows_with_many_rows_per_key(spark):
    """Key 1 has half of the rows, all copies of each other; key 2 has different rows."""
    pairs = [(1, 0)] * 30 + [(2, i) for i in range(30)] + [(3, 0), (0, 0)]
    rows = spark.createDataFrame(pairs, "k bigint, v bigint")
    for count in [1, 20, 31, 40, 61, 62, 99]:
        found = [tuple(r) for r in first_rows(rows, count, "k").collect()]
        assert sorted(k for k, _ in found) == sorted(k for k, _ in pairs)[:count]
        assert not Counter(found) - Counter(pairs)


def test_first_rows_places_nan_and_null_last(spark):
    keys = [1.0, 2.0, float("nan"), None] * 5
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k double, v int")
    for count, wanted in [(6, (5, 1, 0, 0)), (12, (5, 5, 2, 0)), (18, (5, 5, 5, 3)), (40, (5, 5, 5, 5))]:
        found = [r.k for r in first_rows(rows, count, "k").collect()]
        nans = sum(k is not None and k != k for k in found)
        assert (found.count(1.0), found.count(2.0), nans, found.count(None)) == wanted


def test_capped_keeps_duplicated_reviews_apart(spark):
    rows = spark.createDataFrame([("same", i) for i in range(20)], "review_id string, stars int")
    reviews = keyed_reviews(rows)
    kept = sorted(r.stars for r in capped(reviews, 5).collect())
    assert len(set(kept)) == 5
    assert sorted(r.stars for r in capped(reviews.repartition(3), 5).collect()) == kept
    assert capped(reviews, 0).count() == 20


def facts(spark):
    """A third of the rows has one key, and another part has none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 50)
    )
    return spark.range(600).select("id", key.alias("k"))


def test_joins_agree_with_a_plain_join(spark):
    rows = facts(spark)
    lookup = rows.where("k IS NOT NULL AND k <> 'k5'").groupBy("k").agg(F.count("*").alias("n"))
    expected = sorted(map(tuple, rows.join(lookup, "k", "left").select("id", "k", "n").collect()), key=str)
    for joined in [
        salted_join(rows, lookup, "k", "id"),
        hot_key_join(rows, lookup, "k", "n", "id"),
        lookup_join(rows, lookup, "k", "id"),
        lookup_join(rows, lookup, "k", "id", max_broadcast_rows=3),
    ]:
        found = sorted(map(tuple, joined.select("id", "k", "n").collect()), key=str)
        assert found == expected


def bronze(spark):
    rows = [("r1", "Title", "Body", 5, "toys", "2024-01-03"), ("r2", None, "Body", 4, "toys", "2024-1-4"),
            ("r3", "", "", 3, "arts", "2024-02-01"), ("r4", "T", None, None, None, "2024-03-01")]
    return spark.createDataFrame(
        rows, "review_id string, review_title string, review_body string, stars int,"
              " product_category string, review_date string"
    )


def test_features(spark):
    found = {r.review_id: r for r in review_features(bronze(spark)).collect()}
    assert [found[f"r{i}"].review_text for i in range(1, 5)] == ["Title Body", " Body", " ", "T "]
    assert [found[f"r{i}"].label for i in range(1, 5)] == [1.0, 1.0, 0.0, 0.0]
    assert [found[f"r{i}"].category_name_len for i in range(1, 5)] == [4, 4, 4, 0]
    assert found["r1"].unix_time == 1704240000
    assert found["r2"].review_dt.isoformat() == "2024-01-04"


def test_a_given_dimension_and_both_join_ways(spark):
    dimension = spark.createDataFrame([("toys", 99)], "product_category string, category_name_len int")
    for limit in [0, 10]:
        joined = join_category(bronze(spark), dimension, max_broadcast_rows=limit)
        assert {r.review_id: r.category_name_len for r in joined.collect()} == {
            "r1": 99, "r2": 99, "r3": 0, "r4": 0}
    assert category_dimension(bronze(spark)).count() == 2


def test_scaling_input_drops_rows_without_stars(spark):
    assert {r.text for r in scaling_input(bronze(spark)).collect()} == {"Title Body", " Body", " "}


def test_samples_are_nested_and_repeatable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("r"), "id").alias("review_id"))
    small = {r.review_id for r in hash_sample(rows, 0.05).collect()}
    again = {r.review_id for r in hash_sample(spread(rows, 3), 0.05).collect()}
    large = {r.review_id for r in hash_sample(rows, 0.10).collect()}
    assert small == again and small < large
    assert 180 < len(small) < 320 and 420 < len(large) < 580
    assert hash_sample(rows, 1.0).count() == 5000
    assert {r.review_id for r in hash_sample(rows, 0.05, seed=1).collect()} != small


def test_fraction_rules():
    assert run_fraction(0.2, True) == 0.005 and run_fraction(0.2, False) == 0.2
    assert run_fraction(0.001, True) == 0.001
    assert growing_fractions(0.4, 3) == [0.4, 0.8, 1.0]


def test_folds_are_even(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("review_id"))
    sizes = [r["count"] for r in with_fold(rows, 3).groupBy("fold").count().collect()]
    assert len(sizes) == 3 and all(900 < n < 1100 for n in sizes)


def test_a_bounded_sample_keeps_shares_and_repeats(spark):
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("review_id"), (F.col("id") % 5 == 0).cast("double").alias("label")
    )
    one, two = (at_most(rows, 1000, "label").collect() for _ in range(2))
    assert sorted(one) == sorted(two) and 800 < len(one) <= 1000
    assert abs(sum(r.label for r in one) / len(one) - 0.2) < 0.04
    assert at_most(rows, 20_000, "label").count() == 20_000


def timed(spark):
    return spark.range(1, 101).select(
        (F.col("id") * 86400).alias("unix_time"), F.lit(None).cast("date").alias("review_dt")
    )


def test_splits_are_disjoint_and_ordered(spark):
    assert tuple(time_cuts(timed(spark)).first()) == (70 * 86400, 85 * 86400)
    assert tuple(timed(spark).approxQuantile("unix_time", [0.7, 0.85], 0.0)) == (70 * 86400, 85 * 86400)
    assert [part.count() for part in split_by_time(timed(spark))] == [70, 15, 15]
    sizes = {r.split: r["count"] for r in with_split(timed(spark)).groupBy("split").count().collect()}
    assert sizes == {"train": 70, "valid": 15, "test": 15}
    rough = time_cuts(timed(spark), relative_error=0.01).first()
    assert abs(rough.train_end / 86400 - 70) <= 1


def test_sketches_of_groups_merge_to_cuts_of_all(spark):
    rows = spark.range(200_000).select(
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("unix_time"), (F.col("id") % 7).alias("part")
    )
    cuts = cuts_of_sketches(time_sketches(rows, ["part"], 0.01), 0.01).first()
    ranks = rows.agg(*[(F.count_if(F.col("unix_time") <= cuts[c]) / F.count("*")).alias(c)
                       for c in ("train_end", "valid_end")]).first()
    assert abs(ranks.train_end - 0.70) <= 0.01 and abs(ranks.valid_end - 0.85) <= 0.01
    nothing = time_sketches(rows.where("unix_time < 0"), ["part"], 0.01)
    assert tuple(cuts_of_sketches(nothing, 0.01).first()) == (None, None)


def test_spreading(spark):
    rows = spark.range(8000).coalesce(1)
    sizes = partition_sizes(spread(rows, 8)).collect()
    assert [r.rows_in_partition for r in sizes] == [1000] * 8
    assert spread_over_cores(rows).rdd.getNumPartitions() == 8
    many = spark.range(10).repartition(16)
    assert spread_over_cores(many) is many
