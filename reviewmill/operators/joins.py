"""Left joins of a large table with a lookup table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import written

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32
# A key with more than this share of all facts is hot; no task gets much more than this share.
HOT_SHARE = 1.0 / 100_000
SALT, WEIGHT = "_salt", "_weight_of_key"
# Parts into which facts without a key are dealt, which match nothing.
NULL_PARTS = 1_024


def fits_broadcast(
    lookup: DataFrame, key: str, max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Whether a stored lookup has few enough rows, and bytes in all its columns, to be sent around.

    A key that occurs twice would repeat facts, so it is an error.
    """
    row = F.octet_length(F.to_json(F.struct("*")))
    size = lookup.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(row), F.lit(0)).alias("bytes"),
    ).first()
    fits = size["rows"] <= max_rows and size["bytes"] <= max_bytes
    if fits and lookup.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").take(1):
        raise ValueError(f"the lookup has several rows for one {key}")
    return fits


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Broadcast the lookup where its measured size allows it, else salt its keys by their weight.

    The lookup is derived once and measured in the files it was written to. A larger one is told how
    many facts each key has, from one more pass over the keys alone.
    """
    lookup = written(lookup, "lookup")
    if fits_broadcast(lookup, key, max_broadcast_rows):
        return facts.join(F.broadcast(lookup), key, "left")
    weights = facts.groupBy(key).agg(F.count("*").alias(WEIGHT))
    weighted = lookup.join(weights, key, "left").fillna(0, [WEIGHT])
    return hot_key_join(facts, weighted, key, WEIGHT, spread_by).drop(WEIGHT)


def salted_join(facts: DataFrame, lookup: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Spread every key over several tasks; each lookup row is repeated once per salt.

    Null keys match nothing, but they are spread as well and do not end up in one task.
    """
    salted = facts.withColumn(SALT, F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    return salted.join(lookup.withColumn(SALT, salts), [key, SALT], "left").drop(SALT)


def hot_key_join(
    facts: DataFrame, lookup: DataFrame, key: str, weight: str, spread_by: str
) -> DataFrame:
    """Left join for lookups too large to repeat, where ``weight`` counts each key's facts.

    A key is hot if it holds more than ``HOT_SHARE`` of all facts. There are at most 1 / ``HOT_SHARE``
    such keys, so their list is small enough to broadcast. A hot key gets as many salts as it holds
    such shares, and only its lookup row is repeated. Facts without a key are spread as well. The
    lookup is used three times, so it is written once.
    """
    lookup = written(lookup, "lookup")
    share = lookup.agg(F.sum(weight).cast("double") * HOT_SHARE).scalar()
    salted = lookup.withColumn(
        "_salts", F.greatest(F.ceil(F.try_divide(F.col(weight), share)), F.lit(1)).cast("int")
    )
    hot_keys = salted.where("_salts > 1").select(key, F.col("_salts").alias("_hot_salts"))
    parts = F.when(F.col(key).isNull(), NULL_PARTS).otherwise(F.coalesce("_hot_salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(spread_by), parts)
    salted_facts = (
        facts.join(F.broadcast(hot_keys), key, "left")
        .withColumn(SALT, salt.cast("int"))
        .drop("_hot_salts")
    )
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_lookup = salted.withColumn(SALT, F.explode(salts)).drop("_salts")
    return salted_facts.join(salted_lookup, [key, SALT], "left").drop(SALT)


def frequent_key_join(facts: DataFrame, lookup: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join with a lookup of every key that facts have; ``weight`` counts each key's facts.

    The lookup rows of keys with more than ``HOT_SHARE`` of all facts, of which there are at most
    1 / ``HOT_SHARE``, are sent around. Only the facts of the other keys are shuffled, none of which
    is hot, so none needs salts. For lookups of few bytes a row.
    """
    lookup = written(lookup, "lookup")
    share = F.col(weight) > lookup.agg(F.sum(weight).cast("double") * HOT_SHARE).scalar()
    hot = F.broadcast(lookup.where(share))
    rest = facts.join(hot.select(key), key, "left_anti")
    return facts.join(hot, key).unionByName(rest.join(lookup.where(~share), key))
