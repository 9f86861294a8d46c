"""Review feeds made of the general-purpose tables (documents, events, orders' lines).

Ingest gets a feed with known defects: missing bodies, missing and out-of-range ratings, and a day
that does not exist. Work on texts gets every document as it is, and the feature operators get rows
with gaps that validation would have kept from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.reviews import FEED_PREFIX
from reviewmill.sources.feeds import FEED_COLUMN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DAY = "CAST(date_add(DATE'2022-01-01', CAST(doc_id % 730 AS INT)) AS STRING)"
RATING = "CAST(1 + (doc_id * 7) % 5 AS INT)"


def _of_documents(spark: SparkSession, sf_dir: str, **fields: str) -> DataFrame:
    """Keyed reviews, one per document; the fields named here are given as SQL."""
    given = [f"{sql} AS {name}" for name, sql in fields.items()]
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('r', doc_id) AS review_id",
        "concat('p', doc_id % 50) AS product_id",
        "concat('u', doc_id % 97) AS reviewer_id",
        "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE substr(text, 1, 20) END AS review_title",
        "lang AS language",
        "CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END AS verified_purchase",
        "CAST(NULL AS STRING) AS vine",
        "doc_id",
        "CAST(doc_id AS STRING) AS row_key",
        *given,
    )


def document_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with defects that validation has to find."""
    return _of_documents(
        spark, sf_dir,
        stars=f"CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 9 ELSE {RATING} END",
        review_body="CASE WHEN doc_id % 17 = 0 THEN '' ELSE text END",
        product_category="source",
        review_date=f"CASE WHEN doc_id % 23 = 0 THEN '2024-02-31' ELSE {DAY} END",
    )


def whole_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed without defects: every document with its whole text. Some reviews have no title."""
    return _of_documents(
        spark, sf_dir, stars=RATING, review_body="text", product_category="source", review_date=DAY
    )


def patchy_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews that were never validated: no body, rating, category or day here and there."""
    return _of_documents(
        spark, sf_dir,
        stars=f"CASE WHEN doc_id % 29 = 0 THEN NULL ELSE {RATING} END",
        review_body="CASE WHEN doc_id % 17 = 0 THEN NULL ELSE text END",
        product_category="CASE WHEN doc_id % 13 = 0 THEN NULL ELSE source END",
        review_date=f"CASE WHEN doc_id % 23 = 0 THEN '2024-02-31' ELSE {DAY} END",
    )


def event_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews, one per event; each event type is a feed of its own."""
    return table(spark, sf_dir, "events").select(*event_review_columns())


def event_review_columns() -> list:
    return [
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("A"), F.col("event_id") % 300).alias("asin"),
        (
            F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1000)
        ).cast("bigint").alias("timestamp"),
        (F.lit(1) + F.col("event_id") % 5).cast("double").alias("rating"),
        F.col("props").alias("text"),
        F.col("event_type").alias("title"),
        (F.col("event_type") == "purchase").alias("verified_purchase"),
        F.concat(F.lit(FEED_PREFIX), "event_type").alias(FEED_COLUMN),
        F.col("event_id").cast("string").alias("row_key"),
    ]


def line_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings for volume, one per order line, with the part type as category."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("p_type").alias("product_category"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("stars"),
        F.col("l_shipdate").cast("date").cast("string").alias("review_date"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a rule in place of a model: label, prediction and score."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("quality").cast("double").alias("label"),
        (F.col("n_chars") % 3 > 0).cast("double").alias("prediction"),
        F.round(F.col("n_chars") / F.lit(100.0)).alias("score"),
    )
