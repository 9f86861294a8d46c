"""Features, samples, splits, joins, dashboards and SQL reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.catalog.common import (
    features,
    patchy,
    reviews,
    silver,
    spread_features,
    whole,
)
from reviewmill.catalog.oracle_views import (
    DOCUMENT_REVIEWS,
    EVENT_REVIEWS,
    PATCHY_TO_FEATURES,
    REVIEWS_TO_FEATURES,
    REVIEWS_TO_SILVER,
)
from reviewmill.functions.draws import draw_hex, hex_threshold
from reviewmill.operators.dashboards import (
    business_insights,
    category_days,
    category_trend,
    daily_volume,
    data_quality,
    data_quality_report,
)
from reviewmill.operators.features import (
    category_dimension,
    join_category,
    review_features,
    scaling_input,
    silver_reviews,
)
from reviewmill.operators.layout import spread
from reviewmill.operators.normalise import raw_reviews
from reviewmill.operators.ordering import first_rows
from reviewmill.operators.sampling import growing_fractions, hash_sample, with_fold
from reviewmill.operators.splits import (
    cuts_of_sketches,
    split_sizes,
    time_cuts,
    time_sketches,
    with_split,
)
from reviewmill.operators.text_stats import STATISTICS, TextStats
from reviewmill.plans.scaling import BASE_FRACTION, PARTITIONS
from reviewmill.plans.rollups import refresh_rollups, stored_category_days
from reviewmill.session import shared_folder, use_utc, written
from reviewmill.sinks.tables import CSV, read_csv, write_bronze, write_csv
from reviewmill.sources.examples import event_reviews, line_reviews
from reviewmill.streaming.ingest import StreamTarget, write_batch

LIMIT_ROWS = 5000
SAMPLE_FRACTION = 0.20
FOLDS = 3
RANK_ERROR = 0.01


def feat_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings are shown as doubles, because some are null."""
    rows = review_features(patchy(spark, sf_dir)).drop("category_name_len")
    return rows.withColumn("stars", F.col("stars").cast("double"))


def feat_category_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_category(patchy(spark, sf_dir))
    return joined.select("review_id", "product_category", "category_name_len")


def category_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_dimension(patchy(spark, sf_dir))


def scal_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaling_input(patchy(spark, sf_dir))


def limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_reviews(use_utc(spark), sf_dir).select(
        F.col("row_key").cast("bigint").alias("event_id"),
        F.concat_ws(" ", "title", "text").alias("review_text"),
        F.when(F.col("rating") >= 4, 1.0).otherwise(0.0).alias("label"),
    )
    return first_rows(rows, LIMIT_ROWS, "event_id")


def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_sample(whole(spark, sf_dir), SAMPLE_FRACTION).select("review_id", "stars")


def sample_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the growing samples, all counted in one pass."""
    fractions = growing_fractions(BASE_FRACTION, len(PARTITIONS))
    draw = draw_hex(F.col("review_id"))
    counts = whole(spark, sf_dir).agg(
        *[F.count_if(draw < hex_threshold(f)).alias(f"step_{i}") for i, f in enumerate(fractions, 1)]
    )
    return counts.unpivot(
        [], [f"step_{i}" for i in range(1, len(fractions) + 1)], "step", "sampled_rows"
    )


def split_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_cuts(features(spark, sf_dir))


def split_quantiles_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cuts from one stored sketch per month, and whether their exact ranks are near enough."""
    rows = features(spark, sf_dir)
    month = rows.withColumn("month", F.date_trunc("month", "review_dt"))
    sketches = written(time_sketches(month, ["month"], RANK_ERROR), "time-sketches")
    cuts = cuts_of_sketches(sketches, RANK_ERROR).first()
    wanted = {"train_end": 0.70, "valid_end": 0.85}
    time = F.col("unix_time")
    ranks = rows.agg(
        F.count("*").alias("n"),
        *[f.alias(f"{name}_{kind}") for name in wanted for kind, f in (
            ("below", F.count_if(time < cuts[name])), ("upto", F.count_if(time <= cuts[name])))],
    )
    near = [
        F.struct(F.lit(name).alias("cut"), F.col("n").alias("rows"), (
            (F.col(f"{name}_below") / F.col("n") <= share + RANK_ERROR)
            & (F.col(f"{name}_upto") / F.col("n") >= share - RANK_ERROR)).alias("near"))
        for name, share in wanted.items()
    ]
    return ranks.select(F.inline(F.array(*near)))


def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sizes(with_split(features(spark, sf_dir)))


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fold(whole(spark, sf_dir), FOLDS).groupBy("fold").agg(F.count("*").alias("rows"))


def text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = TextStats().transform(spread_features(spark, sf_dir))
    return rows.select("review_id", *[f"txt_{name}" for name in STATISTICS])


def dash_data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the reviews as they arrive: after validation nothing is missing."""
    return data_quality(reviews(spark, sf_dir))


def dash_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_volume(category_days(silver(spark, sf_dir)))


def dash_business_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business_insights(category_days(silver(spark, sf_dir)))


def dash_business_insights_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table over the order lines, for volume."""
    return business_insights(category_days(silver_reviews(line_reviews(use_utc(spark), sf_dir))))


def dash_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insights from stored parts, after a run was repeated and a stream has added to the table."""
    folder = shared_folder(use_utc(spark), "rollups")
    target = StreamTarget(
        f"{folder}/bronze", f"{folder}/rejects", f"{folder}/audit", f"{folder}/checkpoint"
    )
    documents = whole(spark, sf_dir)
    write_bronze(documents.limit(50), target.bronze_path, "documents")
    refresh_rollups(spark, target.bronze_path)
    write_bronze(documents, target.bronze_path, "documents")
    write_batch(raw_reviews(event_reviews(spark, sf_dir)), 0, target)
    return business_insights(stored_category_days(spark, target.bronze_path))


def dash_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks as CSV and back, with lines that do not fit."""
    folder = shared_folder(use_utc(spark), "csv")
    body = F.concat(F.lit('"'), "review_title", F.lit('", '), "review_body", F.lit("\n, "))
    rows = whole(spark, sf_dir).select("review_id", "stars", body.alias("review_body"))
    # A file is read by one task, so there are as many as the scan has splits.
    write_csv(spread(rows, max(3, rows.rdd.getNumPartitions())), folder)
    broken = rows.where("stars = 5").select(
        "review_id", F.lit("five").alias("stars"), F.lit("short").alias("review_body")
    )
    broken.write.mode("append").option("header", True).options(**CSV).csv(folder)
    stored = read_csv(spark, folder, "review_id string, stars int, review_body string", "corrupt")
    return stored.select(
        "review_id", "stars", "review_body", F.col("corrupt").isNotNull().alias("corrupt")
    )


def _dated(trend: DataFrame) -> DataFrame:
    return trend.withColumn("month_start", F.col("month_start").cast("date"))


def sql_category_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(category_trend(category_days(silver(spark, sf_dir))))


def sql_category_trend_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report over the order lines, for volume."""
    lines = silver_reviews(line_reviews(use_utc(spark), sf_dir))
    return _dated(category_trend(category_days(lines)))


def sql_data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the reviews as they arrive."""
    return data_quality_report(reviews(spark, sf_dir))


QUERIES = {
    "feat_base": feat_base,
    "feat_category_join": feat_category_join,
    "category_dim": category_dim,
    "scal_prepare": scal_prepare,
    "limit_n": limit_n,
    "sample_hash": sample_hash,
    "sample_growth": sample_growth,
    "split_quantiles": split_quantiles,
    "split_quantiles_sketch": split_quantiles_sketch,
    "temporal_split": temporal_split,
    "cv_folds": cv_folds,
    "text_stats": text_stats,
    "dash_data_quality": dash_data_quality,
    "dash_daily_volume": dash_daily_volume,
    "dash_business_insights": dash_business_insights,
    "dash_business_insights_lines": dash_business_insights_lines,
    "dash_incremental": dash_incremental,
    "dash_csv_roundtrip": dash_csv_roundtrip,
    "sql_category_trend": sql_category_trend,
    "sql_category_trend_lines": sql_category_trend_lines,
    "sql_data_quality": sql_data_quality,
}

_DRAW = "('0x' || substr(md5('42:' || review_id), 1, 8))::BIGINT"
_LINES = """WITH line_reviews AS (
  SELECT p_type AS product_category, 1 + trunc(l_quantity)::INTEGER % 5 AS stars,
    CAST(l_shipdate AS DATE) AS review_dt
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_INSIGHTS = """SELECT product_category, review_dt AS review_day, count(*) AS reviews,
  avg(stars) AS avg_stars, avg(CASE WHEN stars >= 4 THEN 1 ELSE 0 END) AS positive_rate"""
_TREND = """SELECT product_category, CAST(date_trunc('month', review_dt) AS DATE) AS month_start,
  count(*) AS reviews, avg(stars) AS avg_stars,
  avg(CASE WHEN stars >= 4 THEN 1 ELSE 0 END) AS positive_rate"""
_STEPS = " UNION ALL ".join(
    f"SELECT 'step_{i}' AS step, count(*) AS sampled_rows FROM draws"
    f" WHERE draw < CAST(floor({f} * 4294967296) AS BIGINT)"
    for i, f in enumerate(growing_fractions(BASE_FRACTION, len(PARTITIONS)), 1)
)

ORACLES = {
    "feat_base": f"""{PATCHY_TO_FEATURES}
SELECT review_id, review_date, CAST(stars AS DOUBLE) AS stars, product_category, review_title,
  review_body, review_text,
  lab AS label, review_dt, unix_time FROM features""",
    "feat_category_join": f"""{PATCHY_TO_FEATURES}
SELECT review_id, product_category,
  CAST(coalesce(length(product_category), 0) AS INTEGER) AS category_name_len FROM valid""",
    "category_dim": f"""{PATCHY_TO_FEATURES}
SELECT DISTINCT product_category, CAST(length(product_category) AS INTEGER) AS category_name_len
FROM valid WHERE product_category IS NOT NULL""",
    "scal_prepare": f"""{PATCHY_TO_FEATURES}
SELECT coalesce(review_title, '') || ' ' || coalesce(review_body, '') AS text, stars,
  CASE WHEN stars >= 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM valid WHERE stars IS NOT NULL""",
    "limit_n": f"""SELECT event_id, event_type || ' ' || props AS review_text,
  CASE WHEN 1 + event_id % 5 >= 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS label
FROM events ORDER BY event_id LIMIT {LIMIT_ROWS}""",
    "sample_hash": f"""{REVIEWS_TO_FEATURES}
SELECT review_id, stars FROM valid WHERE {_DRAW} < {SAMPLE_FRACTION} * 4294967296""",
    "sample_growth": f"""{REVIEWS_TO_FEATURES},
draws AS (SELECT {_DRAW} AS draw FROM valid) {_STEPS}""",
    "split_quantiles": f"""{REVIEWS_TO_FEATURES}
SELECT quantile_disc(unix_time, 0.70) AS train_end, quantile_disc(unix_time, 0.85) AS valid_end
FROM features""",
    "split_quantiles_sketch": f"""{REVIEWS_TO_FEATURES}
SELECT unnest(['train_end', 'valid_end']) AS cut, (SELECT count(*) FROM features) AS rows,
  true AS near""",
    "dash_incremental": f"""{EVENT_REVIEWS}, {REVIEWS_TO_SILVER.removeprefix("WITH ")},
every AS (SELECT product_category, review_dt, stars FROM silver UNION ALL
  SELECT product_category, CAST(review_date AS DATE), CAST(stars AS INTEGER) FROM event_reviews)
{_INSIGHTS} FROM every GROUP BY 1, 2""",
    "dash_csv_roundtrip": f"""{REVIEWS_TO_FEATURES}
SELECT review_id, stars, '"' || review_title || '", ' || review_body || chr(10) || ', '
  AS review_body, false AS corrupt FROM valid
UNION ALL
SELECT review_id, NULL, 'short', true FROM valid WHERE stars = 5""",
    "temporal_split": f"""{REVIEWS_TO_FEATURES},
cuts AS (SELECT quantile_disc(unix_time, 0.70) AS train_end,
  quantile_disc(unix_time, 0.85) AS valid_end FROM features)
SELECT CASE WHEN unix_time <= train_end THEN 'train' WHEN unix_time <= valid_end THEN 'valid'
  ELSE 'test' END AS split, count(*) AS rows, min(review_dt) AS first_day,
  max(review_dt) AS last_day
FROM features, cuts GROUP BY 1""",
    "cv_folds": f"""{REVIEWS_TO_FEATURES}
SELECT CAST({_DRAW} % {FOLDS} AS INTEGER) AS fold, count(*) AS rows FROM valid GROUP BY 1""",
    "text_stats": f"""{REVIEWS_TO_FEATURES}
SELECT review_id,
  CAST(len(string_split_regex(review_text, '[ \\t\\n\\x0b\\f\\r]+')) AS INTEGER) AS txt_token_count,
  CAST(length(review_text) AS INTEGER) AS txt_char_count,
  CAST(length(review_text) - length(replace(review_text, '!', '')) AS INTEGER)
    AS txt_exclaim_count,
  CASE WHEN review_text = '' THEN 0.0::DOUBLE
    ELSE length(regexp_replace(review_text, '[^A-Z]', '', 'g'))::DOUBLE / length(review_text)
    END AS txt_upper_ratio
FROM features""",
    "dash_data_quality": f"""WITH {DOCUMENT_REVIEWS}
SELECT count(*) AS rows_total, count(*) - count(nullif(review_body, '')) AS null_review_body,
  count(*) - count(stars) AS null_stars FROM document_reviews""",
    "dash_daily_volume": f"""{REVIEWS_TO_SILVER}
SELECT review_dt AS review_day, count(*) AS reviews_count FROM silver GROUP BY 1""",
    "dash_business_insights": f"{REVIEWS_TO_SILVER} {_INSIGHTS} FROM silver GROUP BY 1, 2",
    "dash_business_insights_lines": f"{_LINES} {_INSIGHTS} FROM line_reviews GROUP BY 1, 2",
    "sql_category_trend": f"{REVIEWS_TO_SILVER} {_TREND} FROM silver GROUP BY 1, 2",
    "sql_category_trend_lines": f"{_LINES} {_TREND} FROM line_reviews GROUP BY 1, 2",
    "sql_data_quality": f"""WITH {DOCUMENT_REVIEWS}
SELECT count(*) AS rows_total, count(*) - count(nullif(review_body, '')) AS null_body,
  count(*) - count(*) FILTER (stars IN (1, 2, 3, 4, 5)) AS invalid_stars
FROM document_reviews""",
}
