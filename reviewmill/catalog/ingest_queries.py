"""Scans, ingest, layout and sinks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.catalog.common import reviews, silver, valid, whole
from reviewmill.catalog.oracle_views import (
    ACCURACY,
    CELLS,
    CHECKED,
    DOCUMENT_REVIEWS,
    EVENT_FEED,
    EVENT_REVIEWS,
    F1_BINARY,
    AUC,
    F1_WEIGHTED,
    REVIEWS_TO_FEATURES,
    REVIEWS_TO_SILVER,
    REVIEWS_TO_VALID,
    SCORED,
    VALID,
)
from reviewmill.operators.layout import partition_sizes, spread, with_month_partitions
from reviewmill.operators.normalise import keyed_reviews, raw_reviews
from reviewmill.operators.ordering import first_rows
from reviewmill.operators.scoring import score_card
from reviewmill.operators.validation import (
    INVALID,
    MISSING,
    OUT_OF_RANGE,
    BAD_DATE,
    reject_summary,
    rejected_reviews,
    valid_reviews,
)
from reviewmill.plans.ingest import IngestTarget, Lineage, capped, normalise, run_ingest
from reviewmill.schemas import MODEL_SCORE, PARTITION_COLUMNS, RAW_FEED, REVIEW_COLUMNS
from reviewmill.session import shared_folder, use_utc, written
from reviewmill.sinks.commits import next_place
from reviewmill.sinks.tables import (
    compact_bronze,
    vacuum_bronze,
    write_bronze,
    write_json,
    write_table,
)
from reviewmill.sources.examples import (
    document_reviews,
    event_review_columns,
    event_reviews,
    scored_documents,
)
from reviewmill.sources.feeds import FEED_COLUMN, read_feed, read_mixed_json_feed, stream_feed
from reviewmill.sources.tables import model_rows, read_bronze, read_model_metrics, read_silver
from reviewmill.streaming.ingest import StreamTarget, read_batch_audit, start_ingest

ROW_CAP = 300
SPREAD_PARTITIONS = 8
AUDIT_BATCHES = 3


def src_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the event feed as JSON files and scan it with its declared schema."""
    folder = shared_folder(use_utc(spark), "feed")
    write_json(event_reviews(spark, sf_dir).drop(FEED_COLUMN, "row_key"), folder)
    return read_feed(spark, folder, "raw_review_events")


def src_row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capped(valid(spark, sf_dir), ROW_CAP).select("review_id", "stars", "review_date")


def ingest_norm_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed records; ratings are still the text they arrive as."""
    return reviews(spark, sf_dir).select(*REVIEW_COLUMNS).withColumn(
        "stars", F.col("stars").cast("string")
    )


def ingest_norm_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_reviews(event_reviews(use_utc(spark), sf_dir)).select(*REVIEW_COLUMNS)


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects with their field list as text, which compares the same in every engine."""
    return rejected_reviews(reviews(spark, sf_dir)).withColumn(
        "fields", F.array_join("fields", ",")
    )


def ingest_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(spark, sf_dir).where(F.col("reason") == MISSING).select("row_key", "fields")


def ingest_stars_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _rejects(spark, sf_dir)
    return rejects.where(F.col("error") == OUT_OF_RANGE).select("row_key", "reason", "error")


def ingest_date_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _rejects(spark, sf_dir)
    return rejects.where(F.col("error") == BAD_DATE).select("row_key", "reason", "error")


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(spark, sf_dir)


def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid(spark, sf_dir)


def ingest_reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_summary(rejected_reviews(reviews(spark, sf_dir)))


def ingest_part_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_month_partitions(valid(spark, sf_dir)).select(
        "review_id", "review_date", "language", "review_year", "review_month"
    )


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(use_utc(spark), "bronze")
    write_bronze(valid(spark, sf_dir), folder, "documents")
    return read_bronze(spark, folder)


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir)


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _stored(spark, sf_dir)
        .groupBy("language", "review_year", "review_month")
        .agg(F.count("*").alias("reviews"))
    )


def ingest_metrics_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the batch ingest and count what it stored."""
    folder = shared_folder(use_utc(spark), "ingest")
    target = IngestTarget(f"{folder}/bronze", f"{folder}/rejects", f"{folder}/metrics")
    lineage = Lineage("documents", "raw_review_documents")
    run_ingest(document_reviews(spark, sf_dir), "keyed", target, lineage)
    stored = read_bronze(spark, target.bronze_path).agg(F.count("*")).scalar()
    return spark.read.json(target.metrics_path).select(
        "dataset", "dataset_config", "split", "streaming", "rows_written",
        stored.alias("rows_stored"),
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    pattern = f"{sf_dir}/events.parquet*"
    events = stream_feed(spark, pattern, "events", file_format="parquet", schema=schema)
    return events.select(*event_review_columns())


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest the event feed as a stream and read back what it stored."""
    folder = shared_folder(use_utc(spark), "stream")
    target = StreamTarget(
        f"{folder}/bronze", f"{folder}/rejects", f"{folder}/audit", f"{folder}/checkpoint"
    )
    start_ingest(_event_stream(spark, sf_dir), "raw", target).awaitTermination()
    return read_bronze(spark, target.bronze_path).select(*REVIEW_COLUMNS)


def ingest_batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the document feed in three batches of equal files and add up their batch log.

    A batch has as many files as its share of the scan has splits, so no task writes a whole batch.
    """
    folder = shared_folder(use_utc(spark), "audit")
    arrived = document_reviews(spark, sf_dir)
    files = math.ceil(arrived.rdd.getNumPartitions() / AUDIT_BATCHES)
    write_json(spread(arrived, AUDIT_BATCHES * files), f"{folder}/feed")
    target = StreamTarget(
        f"{folder}/bronze", f"{folder}/rejects", f"{folder}/audit", f"{folder}/checkpoint"
    )
    feed = stream_feed(spark, f"{folder}/feed", "documents", shape="keyed", files_per_batch=files)
    start_ingest(feed, "keyed", target).awaitTermination()
    return read_batch_audit(spark, target.audit_path).agg(
        F.count("*").alias("batches"),
        F.sum("rows").alias("rows_written"),
        F.sum("rejected").alias("rows_rejected"),
        F.max("total_written").alias("last_total"),
    )


def ingest_batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a batch and events as a stream in one table; rows per language and category."""
    folder = shared_folder(use_utc(spark), "both")
    batch = IngestTarget(f"{folder}/bronze", f"{folder}/rejects", f"{folder}/metrics")
    run_ingest(document_reviews(spark, sf_dir), "keyed", batch, Lineage("documents", "documents"))
    stream = StreamTarget(
        batch.bronze_path, batch.rejects_path, f"{folder}/audit", f"{folder}/checkpoint"
    )
    start_ingest(_event_stream(spark, sf_dir), "raw", stream).awaitTermination()
    stored = read_bronze(spark, batch.bronze_path)
    return stored.groupBy("language", "product_category").agg(
        F.count("*").alias("reviews"), F.sum("stars").alias("stars")
    )


def _odd_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event reviews, some with times in micro- or nanoseconds or before 1970."""
    time = F.col("timestamp")
    kind = F.col("row_key").cast("bigint") % 7
    odd = (
        F.when(kind == 0, time * 1_000).when(kind == 1, time * 1_000_000).when(kind == 2, -time)
        .otherwise(time)
    )
    return raw_reviews(event_reviews(use_utc(spark), sf_dir).withColumn("timestamp", odd))


def ingest_bad_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows and rejects of a feed with times in other units, by outcome and year."""
    rows = _odd_times(spark, sf_dir)
    year = F.year(F.to_date("review_date"))
    stored = valid_reviews(rows).select(F.lit("valid").alias("outcome"), year.alias("year"))
    rejects = rejected_reviews(rows).select(
        F.array_join("fields", ",").alias("outcome"), F.lit(0).alias("year")
    )
    return stored.unionByName(rejects).groupBy("outcome", "year").agg(F.count("*").alias("rows"))


def row_cap_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row caps on a key with nulls and many rows per value, small and nearly the whole table."""
    rows = event_reviews(use_utc(spark), sf_dir).select(
        F.col("row_key").cast("bigint").alias("event_id"),
        F.when(F.col("rating") > 1, F.col("rating")).alias("rating"),
    )
    caps = {"small": 100, "large": rows.count() - 100}
    parts = [
        first_rows(rows, cap, "rating").groupBy("rating").agg(F.count("*").alias("rows"))
        .withColumn("cap", F.lit(name))
        for name, cap in caps.items()
    ]
    return parts[0].unionByName(parts[1])


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the silver table and read it back."""
    folder = shared_folder(use_utc(spark), "silver")
    write_table(silver(spark, sf_dir), folder)
    stored = read_silver(spark, folder)
    return stored.withColumn("review_month_start", F.col("review_month_start").cast("date"))


def metrics_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the metrics of two scoring rules as one nested record; read it back as rows."""
    folder = shared_folder(use_utc(spark), "metrics")
    by_length = scored_documents(spark, sf_dir)
    by_score = by_length.withColumn("prediction", (F.col("score") >= 5.0).cast("double"))
    names = ["auc", "f1_weighted", "f1_binary", "accuracy"]
    cards = [
        score_card(rule).select(F.lit(name).alias("model"), *names)
        for name, rule in {"by_length": by_length, "by_score": by_score}.items()
    ]
    models = cards[0].unionByName(cards[1])
    write_json(models.agg(F.collect_list(F.struct("*")).alias("models")), folder)
    return model_rows(read_model_metrics(spark, folder)).select(
        *[F.round(f.name, 9).alias(f.name) if f.name in names else f.name
          for f in MODEL_SCORE.fields if f.name != "valid_auc"]
    )


def bronze_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of a repeated run, a run that broke off, and runs merged in place, as readers see it."""
    folder = shared_folder(use_utc(spark), "snapshot")
    rows = valid(spark, sf_dir)
    odd = F.substring("review_id", 2, 20).cast("bigint") % 2 == 1
    write_bronze(rows.where(odd).limit(5), folder, "odd")
    write_bronze(rows.where(odd), folder, "odd")
    write_bronze(rows.where(~odd), folder, "even")
    _break_off(rows, folder, "late")
    before = read_bronze(spark, folder).agg(F.count("*")).first()[0]
    compact_bronze(spark, folder)
    _break_off(rows, folder, "later")
    vacuum_bronze(spark, folder)
    stored = read_bronze(spark, folder)
    return stored.groupBy("language", "review_year", "review_month").agg(
        F.count("*").alias("reviews"),
        F.sum("stars").alias("stars"),
        F.lit(before).alias("rows_before_merging"),
    )


def _break_off(rows: DataFrame, folder: str, run: str) -> None:
    """Leave the data of a run that never came to its commit."""
    _, place = next_place(rows.sparkSession, folder, run)
    with_month_partitions(rows).write.partitionBy(*PARTITION_COLUMNS).parquet(f"{folder}/{place}")


def _mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed and raw records as JSON lines, some cut off, some with a value of another type."""
    names = [c for c in REVIEW_COLUMNS if c != "vine"]
    keyed = document_reviews(spark, sf_dir).select(
        F.to_json(F.struct(*names)).alias("line"), F.col("doc_id").alias("n")
    )
    keyed = keyed.select(
        F.when(F.col("n") % 31 == 0, F.expr("left(line, length(line) - 1)"))
        .when(F.col("n") % 37 == 0, F.concat(F.lit("["), "line", F.lit("]")))
        .when(F.col("n") % 41 == 0, F.lit('{"review_id": {"part": 1}, "stars": "4"}'))
        .otherwise(F.col("line")).alias("value")
    )
    fields = [f.name for f in RAW_FEED.fields]
    wrong = F.col("row_key").cast("bigint")
    raw = event_reviews(spark, sf_dir).select(
        F.to_json(F.struct(
            *[c for c in fields if c != "rating"],
            F.when(wrong % 43 != 0, F.col("rating")).alias("rating"),
            F.when(wrong % 43 == 0, F.lit("five")).alias("_text"),
        )).alias("value")
    )
    # A rating given as text stands in the place of a number.
    return keyed.union(raw.select(F.replace("value", F.lit('"_text"'), F.lit('"rating"'))))


def ingest_norm_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both record shapes in one file of JSON lines: every record's fields, outcome and error."""
    folder = shared_folder(use_utc(spark), "mixed")
    _mixed_lines(spark, sf_dir).write.text(folder)
    records = read_mixed_json_feed(spark, folder, "raw_review_mixed")
    reviews = written(normalise(records, "mixed"), "normalised")
    rejects = rejected_reviews(reviews).select(
        "reason", F.array_join("fields", ",").alias("fields"), "error"
    )
    stored = valid_reviews(reviews)
    names = [c for c in REVIEW_COLUMNS if c != "vine"]
    outcome = stored.select(
        *names, F.lit("valid").alias("reason"), F.lit(None).cast("string").alias("fields"),
        F.lit(None).cast("string").alias("error"),
    )
    nothing = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in names]
    return outcome.unionByName(rejects.select(*nothing, "reason", "fields", "error"))


def partition_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of partitions, rows in all, and whether no partition has far more than its share."""
    sizes = partition_sizes(spread(whole(spark, sf_dir), SPREAD_PARTITIONS))
    rows = F.sum("rows_in_partition")
    share = rows / SPREAD_PARTITIONS
    return sizes.agg(
        F.count("*").cast("int").alias("partitions"),
        rows.alias("rows"),
        (F.max("rows_in_partition") <= share * 1.2 + SPREAD_PARTITIONS).alias("even"),
    )


QUERIES = {
    "src_feed_scan": src_feed_scan,
    "src_row_cap": src_row_cap,
    "bronze_scan": bronze_scan,
    "metrics_flatten": metrics_flatten,
    "ingest_norm_a": ingest_norm_a,
    "ingest_norm_b": ingest_norm_b,
    "ingest_missing": ingest_missing,
    "ingest_stars_range": ingest_stars_range,
    "ingest_date_check": ingest_date_check,
    "ingest_rejects": ingest_rejects,
    "ingest_valid": ingest_valid,
    "ingest_reject_summary": ingest_reject_summary,
    "ingest_stream": ingest_stream,
    "ingest_batch_audit": ingest_batch_audit,
    "ingest_part_cols": ingest_part_cols,
    "bronze_roundtrip": bronze_roundtrip,
    "ingest_metrics": ingest_metrics_row,
    "silver": silver_table,
    "partition_balance": partition_balance,
    "bronze_snapshot": bronze_snapshot,
    "ingest_norm_mixed": ingest_norm_mixed,
    "ingest_batch_then_stream": ingest_batch_then_stream,
    "ingest_bad_timestamps": ingest_bad_timestamps,
    "row_cap_nulls": row_cap_nulls,
}

_COLUMNS = ", ".join(REVIEW_COLUMNS)
_MIXED = _COLUMNS.replace(", vine", "")
_MIXED_RAW = _MIXED.replace("stars", "CAST(stars AS INTEGER) AS stars").replace(
    "product_category", "'mixed' AS product_category"
)
_NO_FIELDS = ", ".join(f"NULL AS {name}" for name in _MIXED.split(", "))
_AS_TEXT = _COLUMNS.replace("stars", "CAST(stars AS VARCHAR) AS stars")
_FIELDS = """concat_ws(',', CASE WHEN review_id IS NULL OR review_id = '' THEN 'review_id' END,
    CASE WHEN stars IS NULL THEN 'stars' END,
    CASE WHEN review_body IS NULL OR review_body = '' THEN 'review_body' END,
    CASE WHEN review_date IS NULL OR review_date = '' THEN 'review_date' END,
    CASE WHEN language IS NULL OR language = '' THEN 'language' END,
    CASE WHEN product_category IS NULL OR product_category = '' THEN 'product_category' END)"""
_REJECTS = f"""WITH {DOCUMENT_REVIEWS}, {CHECKED},
rejects AS (
  SELECT CAST(doc_id AS VARCHAR) AS row_key,
    CASE WHEN is_missing THEN '{MISSING}' ELSE '{INVALID}' END AS reason,
    CASE WHEN is_missing THEN {_FIELDS} END AS fields,
    CASE WHEN is_missing THEN NULL WHEN is_out_of_range THEN '{OUT_OF_RANGE}'
         ELSE '{BAD_DATE}' END AS error
  FROM checked WHERE is_missing OR is_out_of_range OR is_bad_date)"""
_MONTHS = """CAST(year(CAST(review_date AS DATE)) AS INTEGER) AS review_year,
    CAST(month(CAST(review_date AS DATE)) AS INTEGER) AS review_month"""
_RULE = """SELECT '{name}' AS model, round(auc, 9) AS auc, round({f1w}, 9) AS f1_weighted, round({f1b}, 9) AS f1_binary,
    round({acc}, 9) AS accuracy, CAST(NULL AS DOUBLE) AS train_seconds FROM cells, auc"""


def _rule(name: str, scored: str) -> str:
    body = _RULE.format(name=name, f1w=F1_WEIGHTED, f1b=F1_BINARY, acc=ACCURACY)
    return f"SELECT * FROM (WITH {scored}, {CELLS}, {AUC} {body})"


_BY_SCORE = SCORED.replace(
    "CASE WHEN d.n_chars % 3 > 0", "CASE WHEN round(d.n_chars / 100.0::DOUBLE) >= 5.0"
)

ORACLES = {
    "src_feed_scan": f"""WITH {EVENT_FEED}
SELECT user_id, asin, "timestamp", rating, text, title, verified_purchase,
  'raw_review_events' AS _dataset_config FROM event_feed""",
    "src_row_cap": f"""{REVIEWS_TO_VALID}
SELECT review_id, stars, review_date FROM valid
ORDER BY ('0x' || substr(md5(concat_ws('|', {_COLUMNS})), 1, 13))::BIGINT LIMIT {ROW_CAP}""",
    "bronze_scan": f"{REVIEWS_TO_VALID} SELECT {_COLUMNS}, {_MONTHS} FROM valid",
    "metrics_flatten": f"{_rule('by_length', SCORED)} UNION ALL {_rule('by_score', _BY_SCORE)}",
    "ingest_norm_a": f"WITH {DOCUMENT_REVIEWS} SELECT {_AS_TEXT} FROM document_reviews",
    "ingest_norm_b": f"{EVENT_REVIEWS} SELECT {_COLUMNS} FROM event_reviews",
    "ingest_missing": f"{_REJECTS} SELECT row_key, fields FROM rejects WHERE reason = '{MISSING}'",
    "ingest_stars_range": f"""{_REJECTS}
SELECT row_key, reason, error FROM rejects WHERE error = '{OUT_OF_RANGE}'""",
    "ingest_date_check": f"""{_REJECTS}
SELECT row_key, reason, error FROM rejects WHERE error = '{BAD_DATE}'""",
    "ingest_rejects": f"{_REJECTS} SELECT row_key, reason, fields, error FROM rejects",
    "ingest_valid": f"{REVIEWS_TO_VALID} SELECT {_COLUMNS} FROM valid",
    "ingest_reject_summary": f"""{_REJECTS}
SELECT reason, count(*) AS rejects FROM rejects GROUP BY reason""",
    "ingest_stream": f"""{EVENT_REVIEWS}
SELECT {_COLUMNS.replace("stars", "CAST(stars AS INTEGER) AS stars")} FROM event_reviews""",
    "ingest_batch_audit": f"""WITH {DOCUMENT_REVIEWS}, {CHECKED}
SELECT CAST(3 AS BIGINT) AS batches,
  CAST(count(*) FILTER (NOT is_missing AND NOT is_out_of_range AND NOT is_bad_date) AS BIGINT)
    AS rows_written,
  CAST(count(*) FILTER (is_missing OR is_out_of_range OR is_bad_date) AS BIGINT)
    AS rows_rejected,
  CAST(count(*) FILTER (NOT is_missing AND NOT is_out_of_range AND NOT is_bad_date) AS BIGINT)
    AS last_total
FROM checked""",
    "ingest_part_cols": f"""{REVIEWS_TO_VALID}
SELECT review_id, review_date, language, {_MONTHS} FROM valid""",
    "bronze_roundtrip": f"""{REVIEWS_TO_VALID}
SELECT language, {_MONTHS}, count(*) AS reviews FROM valid GROUP BY ALL""",
    "ingest_metrics": f"""{REVIEWS_TO_VALID}
SELECT 'documents' AS dataset, 'raw_review_documents' AS dataset_config, 'full' AS split,
  false AS streaming, count(*) AS rows_written, count(*) AS rows_stored FROM valid""",
    "ingest_batch_then_stream": f"""{EVENT_REVIEWS}, {DOCUMENT_REVIEWS}, {CHECKED}, {VALID},
every AS (SELECT language, product_category, stars FROM valid UNION ALL
  SELECT language, product_category, CAST(stars AS INTEGER) FROM event_reviews)
SELECT language, product_category, count(*) AS reviews, CAST(sum(stars) AS BIGINT) AS stars
FROM every GROUP BY ALL""",
    "ingest_bad_timestamps": f"""WITH {EVENT_FEED},
odd AS (SELECT CASE event_id % 7 WHEN 0 THEN 'review_date' WHEN 1 THEN 'review_date' ELSE 'valid'
    END AS outcome, CASE WHEN event_id % 7 > 1 THEN CAST(year(make_timestamp("timestamp" * 1000
    * CASE WHEN event_id % 7 = 2 THEN -1 ELSE 1 END)) AS INTEGER) ELSE 0 END AS year FROM event_feed)
SELECT outcome, year, count(*) AS rows FROM odd GROUP BY ALL""",
    "row_cap_nulls": """WITH e AS (
  SELECT nullif(1 + event_id % 5, 1)::DOUBLE AS rating FROM events),
n AS (SELECT rating, row_number() OVER (ORDER BY rating NULLS LAST) AS place,
    count(*) OVER () AS total FROM e)
SELECT 'small' AS cap, rating, count(*) AS rows FROM n WHERE place <= 100 GROUP BY ALL
UNION ALL
SELECT 'large', rating, count(*) FROM n WHERE place <= total - 100 GROUP BY ALL""",
    "partition_balance": f"""{REVIEWS_TO_FEATURES}
SELECT 8 AS partitions, count(*) AS rows, true AS even FROM valid""",
    "bronze_snapshot": f"""{REVIEWS_TO_VALID}
SELECT language, {_MONTHS}, count(*) AS reviews, CAST(sum(stars) AS BIGINT) AS stars,
  (SELECT count(*) FROM valid) AS rows_before_merging FROM valid GROUP BY ALL""",
    "ingest_norm_mixed": f"""{EVENT_REVIEWS}, {DOCUMENT_REVIEWS}, {CHECKED},
keyed AS (
  SELECT *, CASE WHEN doc_id % 31 = 0 OR doc_id % 37 = 0 THEN 'not_a_json_object'
    WHEN doc_id % 41 = 0 THEN 'wrong_type_of_review_id' END AS broken FROM checked)
SELECT {_MIXED}, 'valid' AS reason, NULL AS fields, NULL AS error FROM keyed
WHERE broken IS NULL AND NOT is_missing AND NOT is_out_of_range AND NOT is_bad_date
UNION ALL
SELECT {_MIXED_RAW}, 'valid', NULL, NULL FROM event_reviews WHERE NOT is_text
UNION ALL
SELECT {_NO_FIELDS}, CASE WHEN broken IS NULL AND is_missing THEN '{MISSING}' ELSE '{INVALID}' END,
  CASE WHEN broken IS NULL AND is_missing THEN {_FIELDS} END,
  CASE WHEN broken IS NOT NULL THEN broken WHEN is_missing THEN NULL
    WHEN is_out_of_range THEN '{OUT_OF_RANGE}' ELSE '{BAD_DATE}' END
FROM keyed WHERE broken IS NOT NULL OR is_missing OR is_out_of_range OR is_bad_date
UNION ALL
SELECT {_NO_FIELDS}, '{INVALID}', NULL, 'wrong_type_of_rating' FROM event_reviews WHERE is_text""",
    "silver": f"""{REVIEWS_TO_SILVER}
SELECT {_COLUMNS}, review_dt, is_positive, review_month_start FROM silver""",
}
