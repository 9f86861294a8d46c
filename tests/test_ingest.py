"""Batch and streaming ingest, feeds and stored tables."""

import json

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from reviewmill.catalog import feature_queries, ingest_queries
from reviewmill.operators.validation import rejected_reviews, valid_reviews
from reviewmill.plans.ingest import IngestTarget, Lineage, normalise, run_ingest, union_feeds
from reviewmill.schemas import REVIEW_COLUMNS
from reviewmill.session import path_exists
from reviewmill.sinks.tables import compact_bronze, read_csv, write_bronze, write_csv, write_json
from reviewmill.sources.examples import document_reviews
from reviewmill.sources.feeds import read_feed, read_mixed_json_feed, stream_feed
from reviewmill.sources.tables import (
    model_rows,
    read_bronze,
    read_model_metrics,
    read_scaling,
)
from reviewmill.streaming.ingest import (
    StreamTarget,
    read_batch_audit,
    read_rejects,
    start_ingest,
    write_batch,
)

LINEAGE = Lineage("documents", "raw_review_documents")


def rows_of(frame):
    return sorted(map(tuple, frame.select(*REVIEW_COLUMNS).collect()), key=str)


def batch_target(path):
    return IngestTarget(f"{path}/bronze", f"{path}/rejects", f"{path}/metrics")


def stream_target(path):
    return StreamTarget(f"{path}/bronze", f"{path}/rejects", f"{path}/audit", f"{path}/checkpoint")


def expected(spark):
    return rows_of(valid_reviews(normalise(document_reviews(spark, SMALL), "keyed")))


def test_batch_ingest(spark, tmp_path):
    target = batch_target(tmp_path)
    records = document_reviews(spark, SMALL)
    written = run_ingest(records, "keyed", target, LINEAGE)
    assert written == len(expected(spark))
    assert rows_of(read_bronze(spark, target.bronze_path)) == expected(spark)
    metrics = spark.read.json(target.metrics_path).first()
    assert (metrics.rows_written, metrics.dataset, metrics.split) == (written, "documents", "full")
    assert spark.read.json(target.rejects_path).count() == records.count() - written


def test_append_adds_and_a_batch_replaces_itself(spark, tmp_path):
    records = document_reviews(spark, SMALL)
    count = len(expected(spark))
    appended = batch_target(tmp_path / "a")
    assert [run_ingest(records, "keyed", appended, LINEAGE) for _ in range(2)] == [count, count]
    assert read_bronze(spark, appended.bronze_path).count() == 2 * count
    replaced = batch_target(tmp_path / "b")
    assert [run_ingest(records, "keyed", replaced, LINEAGE, run="third") for _ in range(2)] == [count] * 2
    assert rows_of(read_bronze(spark, replaced.bronze_path)) == expected(spark)


def test_row_cap_counts_valid_rows(spark, tmp_path):
    target = batch_target(tmp_path)
    assert run_ingest(document_reviews(spark, SMALL), "keyed", target, LINEAGE, max_rows=17) == 17
    assert read_bronze(spark, target.bronze_path).count() == 17


def test_stream_equals_batch_and_goes_on_with_new_files(spark, tmp_path):
    feed, target = f"{tmp_path}/feed", stream_target(tmp_path)
    records = document_reviews(spark, SMALL).drop("row_key")
    records.where("doc_id % 4 <> 0").repartition(3).write.json(feed)

    def ingest():
        start_ingest(
            stream_feed(spark, feed, "documents", shape="keyed", files_per_batch=1), "keyed", target
        ).awaitTermination()

    ingest()
    records.where("doc_id % 4 = 0").coalesce(1).write.mode("append").json(feed)
    ingest()
    ingest()
    assert rows_of(read_bronze(spark, target.bronze_path)) == expected(spark)
    audit = read_batch_audit(spark, target.audit_path).orderBy("batch").collect()
    assert [a.batch for a in audit] == [0, 1, 2, 3]
    assert audit[-1].total_written == sum(a.rows for a in audit) == len(expected(spark))
    assert read_rejects(spark, target.rejects_path).count() == sum(a.rejected for a in audit)


def test_two_streams_and_a_batch_share_a_table(spark, tmp_path):
    records = document_reviews(spark, SMALL).drop("row_key")
    targets = []
    for part in range(2):
        feed = f"{tmp_path}/feed{part}"
        records.where(f"doc_id % 3 = {part}").write.json(feed)
        target = StreamTarget(
            f"{tmp_path}/bronze", f"{tmp_path}/rejects", f"{tmp_path}/audit", f"{tmp_path}/check{part}"
        )
        start_ingest(stream_feed(spark, feed, "d", shape="keyed"), "keyed", target).awaitTermination()
        targets.append(target)
    batch = batch_target(tmp_path)
    run_ingest(document_reviews(spark, SMALL).where("doc_id % 3 = 2"), "keyed", batch, LINEAGE)
    assert targets[0].stream != targets[1].stream
    assert rows_of(read_bronze(spark, batch.bronze_path)) == expected(spark)
    assert read_batch_audit(spark, targets[0].audit_path).count() == 2
    compact_bronze(spark, batch.bronze_path, f"{tmp_path}/compact")
    assert rows_of(read_bronze(spark, f"{tmp_path}/compact")) == expected(spark)


def test_a_capped_run_logs_only_rejects_in_its_scope(spark, tmp_path):
    target = batch_target(tmp_path)
    records = document_reviews(spark, SMALL)
    run_ingest(records, "keyed", target, LINEAGE, max_rows=17)
    everything = rejected_reviews(normalise(records, "keyed")).count()
    assert read_rejects(spark, target.rejects_path).count() < everything


def test_csv_keeps_quotes_commas_and_line_breaks(spark, tmp_path):
    rows = [('a "b", c', 1), ("x\ny", 2), ("plain", 3), (None, 4)]
    write_csv(spark.createDataFrame(rows, "name string, n int"), str(tmp_path / "t"))
    found = read_csv(spark, str(tmp_path / "t"), "name string, n int").collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == rows


def test_a_repeated_micro_batch_leaves_its_rows_once(spark, tmp_path):
    target = stream_target(tmp_path)
    reviews = normalise(document_reviews(spark, SMALL), "keyed")
    for _ in range(2):
        write_batch(reviews, 0, target)
    assert rows_of(read_bronze(spark, target.bronze_path)) == expected(spark)
    assert read_rejects(spark, target.rejects_path).count() == rejected_reviews(reviews).count()


def test_a_hot_month_is_split_over_several_files(spark, tmp_path):
    """Nine rows in ten share a month; its folder must not be left to one task."""
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("review_id"),
        F.lit("en").alias("language"),
        F.sha2(F.col("id").cast("string"), 512).alias("review_body"),
        F.when(F.col("id") % 10 == 0, "2024-02-01").otherwise("2024-01-01").alias("review_date"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_bronze(rows.repartition(16), str(tmp_path / "hot"), "a")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "hot").glob("ingest_run=a/language=en/review_year=2024/review_month=1/*.parquet"))
    assert len(files) > 3
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 20_000


MIXED = [
    {"review_id": "k1", "stars": 4, "review_body": "b", "review_date": "2024-01-03", "language": "de",
     "product_category": "c", "verified_purchase": "True"},
    {"review_id": None, "stars": 4, "review_body": "b", "review_date": "2024-01-03", "language": "de",
     "product_category": "c"},
    {"user_id": "u", "asin": "a", "timestamp": 1704240000000, "rating": 5.9, "text": "t",
     "title": "x", "verified_purchase": True},
    {"asin": "a", "timestamp": 1704240000000, "rating": 0.5, "text": "t"},
]


def test_mixed_feed_decides_by_the_key(spark, tmp_path):
    (tmp_path / "feed.json").write_text("\n".join(json.dumps(r) for r in MIXED))
    feed = read_mixed_json_feed(spark, str(tmp_path / "feed.json"), "raw_review_Toys")
    reviews = normalise(feed, "mixed")
    valid = {r.review_id: r for r in valid_reviews(reviews).collect()}
    assert set(valid) == {"k1", "u_a_1704240000000"}
    raw = valid["u_a_1704240000000"]
    assert (raw.stars, raw.product_category, raw.verified_purchase) == (5, "Toys", "True")
    rejects = [(r.reason, r.fields, r.error) for r in rejected_reviews(reviews).collect()]
    assert sorted(rejects, key=str) == [
        ("missing_required", ["review_id"], None), ("validation_error", None, "stars_out_of_range"),
    ]


WRONG = [
    ('{"review_id": "k", "stars": "4"', "not_a_json_object"), ("[1, 2]", "not_a_json_object"),
    ("plain", "not_a_json_object"), ("null", "not_a_json_object"),
    ('{"review_id": {"a": 1}, "stars": "4"}', "wrong_type_of_review_id"),
    ('{"review_id": "k", "stars": [4]}', "wrong_type_of_stars"),
    ('{"asin": "a", "rating": "five", "timestamp": 1}', "wrong_type_of_rating"),
    ('{"asin": "a", "rating": 4, "timestamp": "yesterday"}', "wrong_type_of_timestamp"),
    ('{"asin": "a", "rating": 4, "timestamp": 1, "verified_purchase": "yes"}', "wrong_type_of_verified_purchase"),
]


def test_broken_records_and_wrong_types_are_rejects(spark, tmp_path):
    (tmp_path / "feed.json").write_text("\n".join(line for line, _ in WRONG) + "\n\n")
    reviews = normalise(read_mixed_json_feed(spark, str(tmp_path / "feed.json"), "f"), "mixed")
    assert valid_reviews(reviews).count() == 0
    rejects = rejected_reviews(reviews).collect()
    assert {r.reason for r in rejects} == {"validation_error"}
    assert sorted(r.error for r in rejects) == sorted(error for _, error in WRONG)


def test_numbers_in_place_of_text_and_null_values_are_no_errors(spark, tmp_path):
    lines = ['{"review_id": 7, "stars": 4, "review_body": true, "review_date": "2024-01-03", "language": "de",'
             ' "product_category": "c", "vine": null}',
             '{"user_id": 5, "asin": null, "timestamp": 1704240000000, "rating": 4, "text": "t", "extra": {}}']
    (tmp_path / "feed.json").write_text("\n".join(lines))
    reviews = normalise(read_mixed_json_feed(spark, str(tmp_path / "feed.json"), "f"), "mixed")
    found = {r.review_id: (r.stars, r.review_body) for r in valid_reviews(reviews).collect()}
    assert found == {"7": (4, "true"), "5_na_1704240000000": (4, "t")}


def test_csv_lines_that_do_not_fit_are_kept_beside_the_others(spark, tmp_path):
    (tmp_path / "t.csv").write_text('name,n\n a ,1\nb,two\n"c ""x"", y",3\n')
    found = read_csv(spark, str(tmp_path / "t.csv"), "name string, n int", "broken").collect()
    assert [tuple(r) for r in found] == [(" a ", 1, None), ("b", None, "b,two"), ('c "x", y', 3, None)]


def test_feed_tag_and_union_of_feeds(spark, tmp_path):
    (tmp_path / "feed.json").write_text(json.dumps(MIXED[2]))
    feeds = [
        normalise(read_feed(spark, str(tmp_path / "feed.json"), f"raw_review_{name}"), "raw")
        for name in ["Toys", "Arts"]
    ]
    found = valid_reviews(union_feeds(feeds)).select("product_category").collect()
    assert sorted(r.product_category for r in found) == ["Arts", "Toys"]


def test_metrics_and_scaling_scans(spark, tmp_path):
    models = [{"model": "a", "auc": 0.5, "accuracy": 0.25, "train_seconds": 1.5}, {"model": "b", "auc": 0.75}]
    (tmp_path / "m.json").write_text(json.dumps({"cv_folds": 2, "models": models}, indent=2))
    rows = model_rows(read_model_metrics(spark, str(tmp_path / "m.json"))).collect()
    assert [(r.model, r.auc, r.train_seconds) for r in rows] == [("a", 0.5, 1.5), ("b", 0.75, None)]
    assert not path_exists(spark, str(tmp_path / "none.csv"))
    assert read_scaling(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "s.csv").write_text(
        "experiment,partitions,fraction,train_seconds,cost_proxy\nstrong,4,0.05,3.22,12.88\n"
    )
    row = read_scaling(spark, str(tmp_path / "s.csv")).first()
    assert (row.experiment, row.partitions, row.cost_proxy) == ("strong", 4, 12.88)


def test_silver_and_null_stars(spark):
    from reviewmill.operators.dashboards import (
        business_insights,
        category_days,
        category_trend,
        data_quality,
        data_quality_report,
    )
    from reviewmill.operators.features import silver_reviews

    rows = [("c", 5, "2024-01-03", "x"), ("c", None, "2024-01-03", ""), ("c", 2, "2024-01-03", None)]
    reviews = spark.createDataFrame(
        rows, "product_category string, stars int, review_date string, review_body string"
    )
    silver = silver_reviews(reviews)
    assert [r.is_positive for r in silver.collect()] == [1, 0, 0]
    day = business_insights(category_days(silver)).first()
    assert (day.reviews, day.avg_stars, round(day.positive_rate, 6)) == (3, 3.5, 0.333333)
    month = category_trend(category_days(silver)).first()
    assert (month.reviews, month.avg_stars, round(month.positive_rate, 6)) == (3, 3.5, 0.333333)
    assert tuple(data_quality(silver).first()) == (3, 2, 1)
    assert tuple(data_quality_report(silver).first()) == (3, 2, 1)
    empty = silver.where(F.lit(False))
    assert tuple(data_quality(empty).first()) == (0, 0, 0)


@pytest.fixture
def many_splits(spark):
    """Scans of the small tables have about as many splits as those of large ones."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_roundtrip_has_a_file_per_split(spark, many_splits):
    """A file with line breaks in values is read by one task, and none holds a fixed share of all."""
    splits = feature_queries.whole(spark, SMALL).rdd.getNumPartitions()
    found = feature_queries.dash_csv_roundtrip(spark, SMALL)
    files = found.groupBy(F.input_file_name().alias("file")).agg(
        F.count("review_id").alias("rows"), F.count_if("corrupt").alias("corrupt"),
        F.count("stars").alias("rated"), F.count("review_body").alias("texts"),
    ).collect()
    assert splits > 8 and len([f for f in files if not f.corrupt]) == splits
    assert max(f.rows for f in files) <= 3 * sum(f.rows for f in files) / splits
    rows = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = rows.count() + rows.where("1 + (doc_id * 7) % 5 = 5").count()
    assert sum(f.rows for f in files) == expected


def test_audit_batches_have_as_many_files_as_the_scan_has_splits(spark, many_splits, monkeypatch):
    splits = ingest_queries.document_reviews(spark, SMALL).rdd.getNumPartitions()
    widths = []

    def noted(rows, path):
        widths.append(rows.rdd.getNumPartitions())
        write_json(rows, path)

    monkeypatch.setattr(ingest_queries, "write_json", noted)
    row = ingest_queries.ingest_batch_audit(spark, SMALL).first()
    assert splits > 8 and widths[0] >= splits and row.batches == 3
    assert row.rows_written + row.rows_rejected == spark.read.parquet(f"{SMALL}/documents.parquet").count()
