"""Physical plans: what is pushed to the files, what is broadcast, and that no Python runs."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__
from reviewmill.catalog.common import valid
from reviewmill.operators.dashboards import business_insights, category_days
from reviewmill.operators.features import review_features, silver_reviews
from reviewmill.operators.normalise import keyed_reviews
from reviewmill.operators.validation import rejected_reviews, valid_reviews
from reviewmill.sinks.tables import write_bronze
from reviewmill.sources.tables import read_bronze


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bronze")
    write_bronze(valid(spark, SMALL), path, "all")
    return path


def test_dashboards_read_only_their_columns(spark, bronze_path):
    text = plan(business_insights(category_days(silver_reviews(read_bronze(spark, bronze_path)))))
    schema = text.split("ReadSchema:")[1].split("\n")[0]
    assert "stars" in schema and "product_category" in schema
    assert "review_body" not in schema and "review_title" not in schema


def test_validation_pushes_null_and_blank_checks(spark, bronze_path):
    stored = read_bronze(spark, bronze_path).withColumn("row_key", F.col("review_id"))
    text = plan(valid_reviews(keyed_reviews(stored)))
    assert "IsNotNull(review_body)" in text and "Not(EqualTo(review_body,))" in text
    rejects = plan(rejected_reviews(keyed_reviews(stored)))
    assert "review_title" not in rejects.split("ReadSchema:")[1]


def test_a_day_range_prunes_month_folders(spark, bronze_path):
    part = read_bronze(spark, bronze_path, "2022-03-15", "2022-04-10")
    filters = plan(part).split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "review_year" in filters and "review_month" in filters
    days = {r.review_date for r in part.select("review_date").collect()}
    whole = {r.review_date for r in read_bronze(spark, bronze_path).collect()}
    assert days == {d for d in whole if "2022-03-15" <= d <= "2022-04-10"} and days


def test_category_dimension_is_broadcast_only_within_its_bound(spark, bronze_path):
    stored = read_bronze(spark, bronze_path)
    assert "BroadcastHashJoin" in plan(review_features(stored))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(review_features(stored, max_broadcast_rows=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_insights_aggregate_before_they_shuffle(spark, bronze_path):
    text = plan(silver_reviews(read_bronze(spark, bronze_path)).groupBy("product_category").count())
    assert "partial_count" in text and text.count("Exchange") == 1


@pytest.mark.parametrize(
    "name", ["ingest_valid", "ingest_rejects", "feat_base", "text_stats", "tfidf_terms",
             "eval_auc", "eval_bootstrap_ci", "ngram_vocab", "temporal_split"],
)
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(__spark_entry__.queries()[name](spark, SMALL))
    for operator in ["Python", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert operator not in text
