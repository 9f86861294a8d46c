"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

The first pass reads each text once for its length and the hash of its beginning. Rows that share
neither with another row are done. Only texts that share both are hashed in full, in a second pass.
Which rows these are is told to the second pass by a bitmap of fixed size; a bit that is set by
chance costs a needless hash and nothing else, because groups are formed by the full hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import SPACES, table, text_of
from reviewmill.session import written

PREFIX_CHARS = 256
# The bitmap takes a megabyte, however many rows there are.
BITMAP_BITS = 1 << 23


def normalised(text_col: str):
    return F.regexp_replace(text_of(text_col), SPACES, " ")


def _shape(text_col: str) -> list:
    text = normalised(text_col)
    return [
        F.length(text).alias("_len"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("_prefix"),
    ]


def _bit(length: str = "_len", prefix: str = "_prefix"):
    return F.pmod(F.xxhash64(length, prefix), F.lit(BITMAP_BITS))


def shared_shapes(shapes: DataFrame) -> DataFrame:
    """Pairs of length and prefix hash that more than one row has.

    Both levels are counted in one pass: a length that occurs once gives a pair that occurs once.
    """
    per_shape = shapes.groupBy("_len", "_prefix").agg(F.count("*").alias("_n"))
    return per_shape.where("_n > 1").select("_len", "_prefix")


def bitmap(shapes: DataFrame) -> np.ndarray:
    """Bits of the shapes, as at most ``BITMAP_BITS / 64`` words put together by the executors."""
    bit = _bit()
    words = (
        shapes.select((bit / 64).cast("int").alias("word"), (bit % 64).cast("int").alias("place"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False
) -> DataFrame:
    """Add ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` to the id of every row.

    Texts are equal if they are identical after each run of white space became one space; a null
    text counts as an empty one. Of equal texts the row with the smallest id stays; rows without an
    id come last. Rows that share the smallest id are the same document, and all of them stay. The
    result has one row per input row and no other column of the input, so names cannot clash. An
    empty table gives an empty result. ``text_sha256`` is null for texts that were not read in full,
    unless ``hash_all`` asks for the digest of each one.
    """
    shapes = written(docs.select(*_shape(text_col)), "exact-shapes")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(shared_shapes(shapes)))

    @F.pandas_udf("boolean")
    def survives(bit: pd.Series) -> pd.Series:
        at = bit.to_numpy()
        return pd.Series((bits.value[at >> 6] >> (at & 63)) & 1 == 1)

    shaped = docs.select(
        F.col(id_col).alias("doc_id"),
        *_shape(text_col),
        normalised(text_col).alias("_text"),
    )
    digest = F.sha2("_text", 256)
    hashed = written(
        shaped.withColumn("_survives", survives(_bit())).select(
            "doc_id", "_len", "_prefix", "_survives",
            F.unhex(digest if hash_all else F.when(F.col("_survives"), digest)).alias("_full"),
        ),
        "exact-hashes",
    )
    groups = written(
        hashed.where("_survives")
        .groupBy("_len", "_prefix", "_full")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1"),
        "exact-groups",
    )
    joined = hashed.join(groups, ["_len", "_prefix", "_full"], "left")
    grouped = F.col("group_size").isNotNull()
    keep_id = F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("_full")).alias("text_sha256"),
    )


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), hash_all=True)


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents
), g AS (
  SELECT doc_id, sha256(t) AS text_sha256,
         min(doc_id) OVER (PARTITION BY t) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

QUERIES = {"op10_exact_dedup": op10_exact_dedup}
ORACLES = {"op10_exact_dedup": ORACLE}
