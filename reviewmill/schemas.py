"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types of a stored review.
REVIEW = T.StructType(
    [
        T.StructField("review_id", T.StringType(), False),
        T.StructField("product_id", T.StringType()),
        T.StructField("reviewer_id", T.StringType()),
        T.StructField("stars", T.IntegerType()),
        T.StructField("review_body", T.StringType()),
        T.StructField("review_title", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("review_date", T.StringType()),
        T.StructField("verified_purchase", T.StringType()),
        T.StructField("vine", T.StringType()),
    ]
)
REVIEW_COLUMNS = REVIEW.fieldNames()

# Fields a review must have, and the folders a stored table is split into.
REQUIRED = ["review_id", "stars", "review_body", "review_date", "language", "product_category"]
PARTITION_COLUMNS = ["language", "review_year", "review_month"]

# A feed as it arrives: nothing is guaranteed, so ratings stay text until they are checked.
KEYED_FEED = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "stars" else f.dataType)
        for f in REVIEW.fields
    ]
)
RAW_FEED = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("verified_purchase", T.BooleanType()),
    ]
)

STORED_REVIEW = T.StructType(
    [T.StructField(f.name, f.dataType) for f in REVIEW.fields]
    + [T.StructField("review_year", T.IntegerType()), T.StructField("review_month", T.IntegerType())]
)

REJECT = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("fields", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

BATCH_AUDIT = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rejected", T.LongType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("label", T.DoubleType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("probability", T.ArrayType(T.DoubleType())),
        T.StructField("rawPrediction", T.ArrayType(T.DoubleType())),
    ]
)

MODEL_SCORE = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("f1_weighted", T.DoubleType()),
        T.StructField("f1_binary", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("valid_auc", T.DoubleType()),
        T.StructField("train_seconds", T.DoubleType()),
    ]
)
MODEL_METRICS = T.StructType(
    [
        T.StructField("timestamp_utc", T.StringType()),
        T.StructField("sample_fraction", T.DoubleType()),
        T.StructField("cv_folds", T.IntegerType()),
        T.StructField("cv_parallelism", T.IntegerType()),
        T.StructField("models", T.ArrayType(MODEL_SCORE)),
    ]
)

SCALING = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("partitions", T.IntegerType()),
        T.StructField("fraction", T.DoubleType()),
        T.StructField("train_seconds", T.DoubleType()),
        T.StructField("cost_proxy", T.DoubleType()),
    ]
)
