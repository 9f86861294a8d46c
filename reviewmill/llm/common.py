"""What the operators share: row keys, attaching results to rows, bounded bitmaps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Runs of these characters separate words.
SPACES = r"[\x20\x09-\x0D]+"
NO_ID = 9223372036854775807
# The bitmap of marked rows takes eight megabytes, however many rows there are.
MARK_BITS = 1 << 26


def text_of(column: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Columns ``_id`` and ``_th`` that tell the rows of a table apart.

    Rows with the same id and the same text are one document. Rows without an id sort last; ids are
    whole numbers, and what is none counts as no id.
    """
    return [
        F.coalesce(F.col(id_col).try_cast("bigint"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(text_of(text_col)).alias("_th"),
    ]


def without(rows: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns that the caller is about to add, whatever their letter case."""
    taken = {name.lower() for name in names}
    return rows.select([F.col(f"`{c}`") for c in rows.columns if c.lower() not in taken])


def packed(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row as one column ``_row`` beside its key, so that no other column can clash."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
                       *row_key(id_col, text_col))


def let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small pieces, so that what is made of a piece stays small too."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def number_rows(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column with the 64-bit numbers of each row, from one row's end to the next."""
    buffers = [None, pa.py_buffer(ends.astype(np.int32) * 8), pa.py_buffer(values)]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def numbers_in(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, and the place of each row's first one."""
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], width)[column.offset :][: len(column) + 1]
    ends = ends.astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return data.view(np.int64), (ends[:-1] - ends[0]) // 8


def mark_place() -> Column:
    """The bit of a row with the columns ``_id`` and ``_th``."""
    return F.pmod(F.xxhash64("_id", "_th"), F.lit(MARK_BITS))


def marks(nodes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit for each of the nodes (``_id``, ``_th``)."""
    words = (
        nodes.select(mark_place().alias("at"))
        .select((F.col("at") / 64).cast("int").alias("word"),
                (F.col("at") % 64).cast("int").alias("place"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
        .toPandas()
    )
    bits = np.zeros(MARK_BITS // 64, dtype=np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bits


def is_marked(nodes: DataFrame) -> Column:
    """Whether a row (``_id``, ``_th``) may be among the nodes; a few others are taken for one.

    Lets a join shuffle little beyond the rows that it finds. When the table holds more nodes than
    bits, more rows are shuffled and the result stays the same.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(marks(nodes))

    @F.arrow_udf("boolean")
    def marked(place: pa.Array) -> pa.Array:
        at = place.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[at >> 6] >> (at & 63)) & 1 == 1)

    return marked(mark_place())
