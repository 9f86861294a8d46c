"""Repeated passages: winnowing over line hashes, joining positions, extending, deleting.

A window starts at each line with words and ends where it holds ``min_words`` words. The smallest
line hash in it is its fingerprint; neighbouring windows mostly share theirs, so far fewer lines are
compared than there are. Equal windows choose the same line, so a repeated run of that many words,
which holds at least one whole window, cannot go unseen.

Fingerprints that occur once are dropped by a join. Around the others a match is extended both ways:
the runs of lines that have just enough words, to the right of each start and to the left of each end,
are looked up among all runs around that fingerprint. A longer repeated run is made of such runs, all
of which repeat, whichever documents hold them first, so nothing is compared in pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import packed, row_key, slices, table, text_of, without
from reviewmill.llm.minhash import node
from reviewmill.operators.joins import hot_key_join
from reviewmill.session import written

MIN_WORDS = 50
NODE = "struct<id:bigint,th:bigint>"
RANGES = "array<struct<at:bigint,n:bigint>>"
ADDED = ["n_lines", "removed_lines"]


def worded_lines(text: str | None) -> tuple[list[int], np.ndarray, list[int]]:
    """Place, hash and word count of each line with words.

    Only the words of a line count, not the white space around them.
    """
    places, hashes, counts = [], [], []
    for place, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
        words = line.split()
        if words:
            places.append(place)
            hashes.append(xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63))
            counts.append(len(words))
    return places, np.array(hashes, dtype=np.int64), counts


def shortest_runs(counts: list[int], min_words: int) -> list[tuple[int, int]]:
    """First and last line of the runs that no run of ``min_words`` words can do without.

    Every line of a longer run lies in one of those to the right of a start or to the left of an end.
    Two long lines in a row are a run each, and both are one as well: it decides the blank lines that
    may stand between them.
    """
    upto = np.concatenate(([0], np.cumsum(counts)))
    starts = np.arange(len(counts))
    ends = np.searchsorted(upto, upto[:-1] + min_words) - 1
    found = set(zip(starts[ends < len(counts)].tolist(), ends[ends < len(counts)].tolist()))
    lasts = starts[upto[1:] >= min_words]
    firsts = np.searchsorted(upto, upto[lasts + 1] - min_words, side="right") - 1
    found.update(zip(firsts.tolist(), lasts.tolist()))
    for line in range(len(counts) - 1):
        if min(counts[line], counts[line + 1]) >= min_words:
            found.add((line, line + 1))
    return sorted(found)


def fingerprints(
    hashes: np.ndarray, counts: list[int], min_words: int
) -> dict[int, list[tuple[int, int]]]:
    """The chosen lines, each with the runs that hold a window in which it is the smallest.

    A run is found by the window that begins it.
    """
    found: dict[int, list[tuple[int, int]]] = {}
    chosen: dict[int, int] = {}
    upto = np.concatenate(([0], np.cumsum(counts)))
    for start, last in shortest_runs(counts, min_words):
        if start not in chosen:
            end = int(np.searchsorted(upto, upto[start] + min_words))
            # Of equal minima the last one, so that sliding on keeps it as long as possible.
            chosen[start] = end - 1 - int(np.argmin(hashes[start:end][::-1]))
        found.setdefault(chosen[start], []).append((start, last))
    return found


def fingerprint_rows(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """One row per chosen line: its document and hash, and content and place of its runs."""

    def split(batches):
        for batch in batches:
            for part in slices(batch):
                made = []
                for key, text in zip(part.column("_node").to_pylist(),
                                     part.column("_text").to_pylist()):
                    places, hashes, counts = worded_lines(text)
                    raw = hashes.tobytes()
                    for line, runs in fingerprints(hashes, counts, min_words).items():
                        made.append({
                            "_node": key, "_line": int(hashes[line]), "_runs": [
                                {"run": xxhash.xxh3_64_intdigest(raw[8 * a : 8 * z + 8]) - (1 << 63),
                                 "at": places[a], "n": places[z] - places[a] + 1}
                                for a, z in runs
                            ],
                        })
                yield pa.RecordBatch.from_pylist(made, schema=arrow)

    arrow = pa.schema([
        ("_node", pa.struct([("id", pa.int64()), ("th", pa.int64())])), ("_line", pa.int64()),
        ("_runs", pa.list_(pa.struct([("run", pa.int64()), ("at", pa.int64()), ("n", pa.int64())]))),
    ])
    texts = docs.select(*row_key(id_col, text_col), text_of(text_col).alias("_text"))
    rows = texts.select(node().alias("_node"), "_text").mapInArrow(
        split, f"_node {NODE}, _line bigint, _runs array<struct<run:bigint,at:bigint,n:bigint>>"
    )
    return written(rows, "line-fingerprints")


def repeated_ranges(lines: DataFrame) -> DataFrame:
    """Ranges of line places to delete, per document: the runs that stand earlier as well.

    Lines and runs that fill the table are joined in as many parts as their numbers ask for.
    """
    several = lines.groupBy("_line").agg(F.count("*").alias("_weight")).where("_weight > 1")
    matched = hot_key_join(lines, several, "_line", "_weight", "_node")
    runs = written(
        matched.where("_weight IS NOT NULL").select("_node", F.inline("_runs")), "line-runs"
    )
    firsts = (
        runs.groupBy("run")
        .agg(F.min(F.struct("_node", "at")).alias("_first"), F.count("*").alias("_weight"))
        .where("_weight > 1")
    )
    placed = hot_key_join(runs, firsts, "run", "_weight", "_node")
    return placed.where(F.struct("_node", "at") != F.col("_first")).select("_node", "at", "n")


def kept_ranges(removed: Column, total: Column) -> Column:
    """The ranges between the removed ones, from ranges sorted by their start."""
    def step(state: Column, gap: Column) -> Column:
        upto = F.greatest(state["upto"], gap["at"] + gap["n"])
        here = F.struct(state["upto"].alias("at"), (gap["at"] - state["upto"]).alias("n"))
        return F.struct(
            F.when(here["n"] > 0, F.concat(state["kept"], F.array(here)))
            .otherwise(state["kept"]).alias("kept"),
            upto.alias("upto"),
        )

    start = F.struct(F.array().cast(RANGES).alias("kept"), F.lit(0).cast("bigint").alias("upto"))
    end = F.array(F.struct(total.alias("at"), F.lit(0).cast("bigint").alias("n")))
    return F.aggregate(F.concat(removed, end), start, step, lambda state: state["kept"])


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The rows with later repetitions of passages deleted from the text.

    A passage is a run of lines with ``min_words`` words or more in all; blank lines within it do
    not count. It is later if the same run stands earlier: in a row with a smaller id, in a row
    without an id only if this one has none either, or further up in the same text. The first
    occurrence of every line stays somewhere. All columns stay; ``n_lines`` and ``removed_lines``
    are added and replace columns of these names. A text that only repeats others becomes empty, but
    its row stays. Null texts stay null. Rows with the same id and text are one document and do not
    count as repeating each other. An empty table gives an empty result.
    """
    rows = without(docs, ADDED)
    lines = fingerprint_rows(rows, id_col, text_col, min_words)
    removed = written(
        repeated_ranges(lines).groupBy("_node")
        .agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("_removed"))
        .select(F.col("_node.id").alias("_id"), F.col("_node.th").alias("_th"), "_removed"),
        "line-removed",
    )
    joined = packed(rows, id_col, text_col).join(
        removed.hint("merge"), ["_id", "_th"], "left"
    )
    text = F.col("_row").getField(text_col)
    split = F.split(text, "\n")
    left = F.flatten(
        F.transform("_kept", lambda r: F.slice("_lines", (r["at"] + 1).cast("int"), r["n"].cast("int")))
    )
    cut = F.col("_removed").isNotNull()
    total = F.coalesce(F.size(split), F.lit(0)).cast("bigint")
    shown = (
        joined.withColumn("_lines", F.when(cut, split))
        .withColumn("_kept", F.when(cut, kept_ranges(F.col("_removed"), total)))
        .withColumn("_text", F.when(cut, F.array_join(left, "\n")).otherwise(text))
    )
    kept_lines = F.aggregate("_kept", F.lit(0).cast("bigint"), lambda n, r: n + r["n"])
    return shown.select(
        *[F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c)
          for c in rows.columns],
        F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(total).alias("n_lines"),
        F.when(cut, total - kept_lines).otherwise(F.lit(0).cast("bigint")).alias("removed_lines"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLES: dict[str, str] = {}
