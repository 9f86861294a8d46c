"""Review feeds: files of review records, read as one batch or as a stream of new files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.schemas import KEYED_FEED, RAW_FEED

FEED_COLUMN = "_dataset_config"
ROW_KEY = "row_key"
# Errors of records that cannot be read as one.
BROKEN_RECORD, WRONG_TYPE = "not_a_json_object", "wrong_type_of_"
SCHEMAS = {"raw": RAW_FEED, "keyed": KEYED_FEED}


def read_feed(
    spark: SparkSession,
    path: str,
    feed: str,
    shape: str = "raw",
    file_format: str = "json",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read all files of a feed and tag each record with the feed's name.

    ``shape`` is "raw" for records without a review key and "keyed" for records that have one.
    The schema is given, so reading never starts with a pass that guesses types.
    """
    records = spark.read.format(file_format).schema(schema or SCHEMAS[shape]).load(path)
    return records.withColumn(FEED_COLUMN, F.lit(feed))


def stream_feed(
    spark: SparkSession,
    path: str,
    feed: str,
    shape: str = "raw",
    file_format: str = "json",
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
    bytes_per_batch: int = 64 * 2**30,
) -> DataFrame:
    """Read a feed's files as a stream; a backlog becomes many micro-batches of bounded size.

    ``files_per_batch`` bounds a batch by its files, otherwise ``bytes_per_batch`` does by its bytes.
    """
    reader = spark.readStream.format(file_format).schema(schema or SCHEMAS[shape])
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path).withColumn(FEED_COLUMN, F.lit(feed))


def read_mixed_json_feed(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Read a JSON-lines feed whose records may have either shape.

    Each line is parsed once, into a variant, and the fields are taken out of it by their types.
    ``has_review_id`` tells whether the key occurs in the record, even with a null value: that, and
    not the value, decides the shape of a record. ``record_error`` names what is wrong with a line
    that is no JSON object, or with the first field of its shape that holds a value of another type;
    such a value is not taken for an absent one.
    """
    lines = spark.read.text(path).where("trim(value) != ''")
    parsed = lines.select(F.md5("value").alias(ROW_KEY), F.expr("try_parse_json(value)").alias("_v"))
    keyed, raw = ({f.name: f for f in shape.fields} for shape in (KEYED_FEED, RAW_FEED))
    names = [*keyed, *[name for name in raw if name not in keyed]]
    fields = parsed.select(
        ROW_KEY,
        F.expr("schema_of_variant(_v)").alias("_whole"),
        *[F.try_variant_get("_v", F.lit(f"$.{n}"), "variant").alias(f"_v_{n}") for n in names],
    )
    # The type of each field: null where the key does not occur, VOID for a null value.
    typed = fields.select("*", *[F.schema_of_variant(f"_v_{n}").alias(f"_t_{n}") for n in names])
    has_id = F.col("_t_review_id").isNotNull()
    taken = typed.select(
        ROW_KEY, "_whole", has_id.alias("has_review_id"), *[f"_t_{n}" for n in names],
        *[_taken(n, keyed.get(n), raw.get(n), has_id).alias(n) for n in names],
    )
    wrong = [
        F.when(F.col("has_review_id") == (shape is keyed), F.when(
            F.col(f"_t_{n}").isNotNull() & (F.col(f"_t_{n}") != "VOID") & F.col(n).isNull(), F.lit(n)
        ))
        for shape in (keyed, raw) for n in shape
    ]
    first_wrong = F.concat(F.lit(WRONG_TYPE), F.coalesce(*wrong))
    is_object = F.coalesce(F.startswith("_whole", F.lit("OBJECT")), F.lit(False))
    error = F.when(~is_object, BROKEN_RECORD).otherwise(first_wrong)
    return taken.select(
        *names, "has_review_id", ROW_KEY, error.alias("record_error"), F.lit(feed).alias(FEED_COLUMN)
    )


def _taken(
    name: str, keyed: T.StructField | None, raw: T.StructField | None, has_id: Column
) -> Column:
    """The value of a field as its shape declares it; one of two types becomes text."""
    if keyed is None or raw is None or keyed.dataType == raw.dataType:
        return _typed(name, (keyed or raw).dataType)
    one, two = (_typed(name, f.dataType).cast("string") for f in (keyed, raw))
    return F.when(has_id, one).otherwise(two)


def _typed(name: str, kind: T.DataType) -> Column:
    """The value of a field if it has the type.

    Text is taken from text, numbers and truth values, as feeds write ratings either way; a list or
    an object is none. Numbers and truth values are not taken from text.
    """
    held = F.col(f"_t_{name}")
    if isinstance(kind, T.StringType):
        fits = ~(held.startswith("OBJECT") | held.startswith("ARRAY"))
    elif isinstance(kind, T.BooleanType):
        fits = held == "BOOLEAN"
    else:
        fits = (held == "BIGINT") | (held == "DOUBLE") | held.startswith("DECIMAL")
    return F.when(fits, F.try_variant_get(f"_v_{name}", F.lit("$"), kind.simpleString()))
