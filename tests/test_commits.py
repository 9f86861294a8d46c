"""The log of committed runs, roll-ups beside the table, and what readers see."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from reviewmill.catalog.common import valid
from reviewmill.operators.dashboards import category_days
from reviewmill.operators.features import silver_reviews
from reviewmill.operators.layout import with_month_partitions
from reviewmill.plans.rollups import refresh_rollups, stored_category_days
from reviewmill.schemas import PARTITION_COLUMNS, REVIEW_COLUMNS
from reviewmill.sinks.commits import next_place, read_commits, snapshot_folders
from reviewmill.sinks.tables import compact_bronze, vacuum_bronze, write_bronze
from reviewmill.sources.tables import read_bronze


def rows_of(frame):
    return sorted(map(tuple, frame.select(*REVIEW_COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def reviews(spark):
    return valid(spark, SMALL).cache()


def test_a_table_without_commits_is_empty(spark, tmp_path):
    assert read_bronze(spark, str(tmp_path)).count() == 0
    assert stored_category_days(spark, str(tmp_path)).count() == 0
    assert refresh_rollups(spark, str(tmp_path)) == []


def test_data_without_a_record_is_not_read_and_is_overwritten(spark, tmp_path, reviews):
    path = str(tmp_path)
    _, place = next_place(spark, path, "a")
    with_month_partitions(reviews).write.partitionBy(*PARTITION_COLUMNS).parquet(f"{path}/{place}")
    assert read_bronze(spark, path).count() == 0
    write_bronze(reviews.limit(7), path, "a")
    assert read_bronze(spark, path).count() == 7


def test_a_reader_keeps_its_state_while_a_run_is_repeated(spark, tmp_path, reviews):
    path = str(tmp_path)
    write_bronze(reviews.limit(7), path, "a")
    before = read_bronze(spark, path)
    write_bronze(reviews, path, "a")
    assert before.count() == 7
    assert rows_of(read_bronze(spark, path)) == rows_of(reviews)
    gone = vacuum_bronze(spark, path)
    assert gone == [f"{path}/ingest_run=a"]
    assert rows_of(read_bronze(spark, path)) == rows_of(reviews)


def test_merging_in_place_swaps_at_once(spark, tmp_path, reviews):
    path = str(tmp_path)
    odd = F.length("review_body") % 2 == 1
    write_bronze(reviews.where(odd), path, "a")
    write_bronze(reviews.where(~odd), path, "b")
    write_bronze(reviews.where("false"), path, "empty")
    assert len(snapshot_folders(spark, path)) == 2
    compact_bronze(spark, path)
    assert snapshot_folders(spark, path) == [f"{path}/ingest_run=compacted"]
    assert rows_of(read_bronze(spark, path)) == rows_of(reviews)
    with pytest.raises(ValueError):
        write_bronze(reviews, path, "a")
    write_bronze(reviews, path, "c")
    assert read_bronze(spark, path).count() == 2 * reviews.count()
    compact_bronze(spark, path)
    assert read_bronze(spark, path).count() == 2 * reviews.count()
    assert read_commits(spark, path).count() == 6


def test_roll_ups_follow_the_table_and_read_new_folders_only(spark, tmp_path, reviews):
    path = str(tmp_path)

    def check():
        expected = category_days(silver_reviews(read_bronze(spark, path)))
        columns = expected.columns
        assert sorted(map(tuple, stored_category_days(spark, path).select(columns).collect()), key=str) == sorted(
            map(tuple, expected.collect()), key=str)

    write_bronze(reviews.limit(20), path, "a")
    write_bronze(reviews.limit(9), path, "b")
    assert refresh_rollups(spark, path) == ["ingest_run=a", "ingest_run=b"]
    check()
    write_bronze(reviews, path, "a")
    assert refresh_rollups(spark, path) == ["ingest_run=a~3"]
    check()
    compact_bronze(spark, path)
    check()
    assert refresh_rollups(spark, path) == []
    vacuum_bronze(spark, path)
    check()
