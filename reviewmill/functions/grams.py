"""One- and two-word terms of many texts at once, as arrays of hashes; for use inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.text import MIN_WORD_LENGTH, WORD_BREAK
from reviewmill.llm.common import numbers_in
from reviewmill.llm.shingles import STEP, mixed

# Bytes of words: digits, letters, underscore, and all of characters that take several bytes.
WORD_BYTES = np.array([chr(byte).isalnum() or byte == 95 or byte > 127 for byte in range(256)])
# Words hashed at once, so that the arrays in between stay small.
HASHED_WORDS = 1 << 16
# The bitmap of chosen hashes takes eight megabytes, however many they are.
MARK_BITS = 1 << 26


def worded(text: Column) -> Column:
    """The lower-case text, where only a run of ``WORD_BYTES`` can be a word of ``words``.

    Only a text with other than ASCII characters needs its breaks replaced for that.
    """
    lowered = F.lower(text)
    ascii_only = F.octet_length(lowered) == F.char_length(lowered)
    return F.when(ascii_only, lowered).otherwise(F.regexp_replace(lowered, WORD_BREAK, " "))


@dataclass
class Words:
    """The words of ``data`` that are long enough: where they start, their hashes, their texts."""

    data: np.ndarray
    starts: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray

    def text(self, place: int) -> str:
        end = start = self.starts[place]
        while end < len(self.data) and WORD_BYTES[self.data[end]]:
            end += 1
        return self.data[start:end].tobytes().decode()


def words_in(texts: pa.Array) -> Words:
    """The words of texts that ``worded`` has made."""
    texts = pa.concat_arrays([texts.cast(pa.large_string()), pa.array([""], pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts)]
    # A break after each text, so that no word reaches into the next one.
    ends = offsets - offsets[0] + np.arange(len(offsets))
    data = np.full(ends[-1], 32, np.uint8)
    held = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    filled = np.ones(len(data), bool)
    filled[ends[1:] - 1] = False
    data[filled] = held
    inside = WORD_BYTES[data]
    starts = np.nonzero(inside & ~np.concatenate([[False], inside[:-1]]))[0]
    hashes, lengths = np.empty(len(starts), np.uint64), np.empty(len(starts), np.int64)
    for low in range(0, len(starts), HASHED_WORDS):
        own = starts[low : low + HASHED_WORDS]
        end = starts[low + HASHED_WORDS] if low + HASHED_WORDS < len(starts) else len(data)
        part, within = data[own[0] : end], inside[own[0] : end]
        places = np.arange(len(part)) - np.repeat(own - own[0], np.diff(own, append=end))
        values = mixed((places.astype(np.uint64) * np.uint64(256) + part) * STEP + np.uint64(1))
        hashes[low : low + len(own)] = mixed(np.add.reduceat(values * within, own - own[0]))
        characters = within & ((part & 0xC0) != 0x80)
        lengths[low : low + len(own)] = np.add.reduceat(characters, own - own[0], dtype=np.int64)
    kept = lengths >= MIN_WORD_LENGTH
    starts = starts[kept]
    return Words(data, starts, hashes[kept], np.searchsorted(ends, starts, side="right") - 1)


def hashed_words(column: pa.Array) -> Words:
    """Words of which only the hashes are left, from a binary column with those of each row."""
    hashes, starts = numbers_in(column)
    rows = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(hashes)))
    return Words(np.empty(0, np.uint8), np.empty(0, np.int64), hashes.view(np.uint64), rows)


def term_hashes(terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of terms of one or two words, and the place of each in the list."""
    found = words_in(pa.array(terms, pa.string()))
    places, pairs = pairs_in(found)
    one = np.bincount(found.rows, minlength=len(terms))[found.rows] == 1
    hashes = np.concatenate([found.hashes[one], pairs])
    rows = np.concatenate([found.rows[one], found.rows[places]])
    order = np.argsort(hashes)
    return hashes[order], rows[order]


def pairs_in(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that have another one behind them, and the hashes of the two."""
    places = np.nonzero(words.rows[:-1] == words.rows[1:])[0]
    first, second = words.hashes[places], words.hashes[places + 1]
    return places, mixed(mixed(first) * STEP + second)


def counted(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, how often each occurs, and in how many rows; rows are in order."""
    order = np.argsort(hashes, kind="stable")
    hashes, rows = hashes[order], rows[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    first_in_row = new | np.concatenate([[True], rows[1:] != rows[:-1]])
    starts = np.nonzero(new)[0]
    return (
        hashes[starts],
        np.diff(starts, append=len(hashes)),
        np.add.reduceat(first_in_row, starts, dtype=np.int64),
    )


def marks(rows: DataFrame) -> np.ndarray:
    """A bitmap with a bit for each ``hash`` of a table."""
    words = (
        rows.select(F.pmod("hash", F.lit(MARK_BITS)).alias("at"))
        .select(F.expr("at div 64").alias("word"), (F.col("at") % 64).cast("int").alias("place"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"))
        .toPandas()
    )
    bits = np.zeros(MARK_BITS // 64, dtype=np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bits.view(np.uint64)


def is_marked(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether hashes have a bit; a few without one of their own share another's."""
    at = hashes % np.uint64(MARK_BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
