"""Repeated passages across documents: a sparse de Bruijn graph of words, compacted by joins.

Nodes are runs of 16 words, sampled so that each window of 50 words holds one: the run with the
smallest hash in it. An edge is the run of words from one sampled node of a document to the next, with
both nodes; a document's beginning and end are edges as well. All documents share the graph.

One aggregation over the nodes tells which occur in several documents, which document is the first,
and whether a node has one way in and one way out. This is joined to the places in the documents,
where neighbouring nodes without branches compact to paths. All that runs into a path shares it
whole, so one comparison of document ids decides all windows that a path covers. Only windows that
reach over a branch become edges of 50 words of their own, which a second aggregation decides.

Decided windows join to spans with the place of their source, and a span is removed only if a digest
of its words equals the one of the words at that place.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import (
    SPACES,
    is_marked,
    packed,
    row_key,
    slices,
    table,
    text_of,
    without,
)
from reviewmill.llm.shingles import STEP, WordHashes, mixed
from reviewmill.operators.joins import hot_key_join
from reviewmill.session import written

WINDOW_WORDS = 50
NODE_WORDS = 16
FACTOR = 0x9E3779B97F4A7C15
WRAP = (1 << 64) - 1
ADDED = ["n_words", "n_removed"]
LONG = pa.int64()
SPAN = ["at", "n", "source_id", "source_th", "source_at"]


class RunHashes:
    """Hashes of any runs of one text's words, from running sums of a polynomial modulo 2^64."""

    powers = np.ones(1, dtype=np.uint64)
    inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, words: list[bytes], hashes: WordHashes):
        size = len(words)
        if len(self.powers) < size + 1:
            room = max(size + 1, 4096)
            RunHashes.powers = self.powers_of(FACTOR, room)
            RunHashes.inverses = self.powers_of(pow(FACTOR, -1, 1 << 64), room)
        values = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=size)
        self.sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[:size], out=self.sums[1:])

    @staticmethod
    def powers_of(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each run of words from start up to end."""
        runs = (self.sums[end] - self.sums[start]) * self.inverses[start]
        return mixed(runs + STEP * (end - start).astype(np.uint64))


def sampled_nodes(hashes: np.ndarray, per_window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the leftmost smallest hash of each window, and the first window that each rules.

    The upper halves of the hashes are compared; equal ones count as equal in every text.
    """
    low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width < per_window:
        step = min(width, per_window - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    chosen = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    rules_from = np.concatenate(([0], np.nonzero(np.diff(chosen))[0] + 1))
    return chosen[rules_from], rules_from


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def words_in(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def binary(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def graph_places(docs: DataFrame, id_col: str, text_col: str, window: int, size: int) -> DataFrame:
    """One row per sampled node of each document, with the edges before and after it.

    ``lo`` to ``hi`` are the starts of the windows in which the node is the smallest.
    """

    def sample(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                ids, ths = (part.column(c).to_numpy() for c in ("_id", "_th"))
                counts, columns = np.zeros(part.num_rows, dtype=np.int64), []
                for row, text in enumerate(binary(part.column("_text"))):
                    words = words_in(text)
                    if len(words) < window:
                        continue
                    runs = RunHashes(words, hashes)
                    starts = np.arange(len(words) - size + 1)
                    nodes = runs.of(starts, starts + size)
                    at, lo = sampled_nodes(nodes, window - size + 1)
                    hi = np.append(lo[1:] - 1, len(words) - window)
                    # An edge at the beginning or end differs from any edge between two nodes.
                    edge = runs.of(np.append(0, at), np.append(at + size, len(words)))
                    edge[0] ^= STEP
                    edge[-1] ^= STEP
                    counts[row] = len(at)
                    columns.append((signed(nodes[at]), at, lo, hi, signed(edge[:-1]), signed(edge[1:])))
                arrays = [np.concatenate(c) for c in zip(*columns)] or [np.empty(0, np.int64)] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, counts)), pa.array(np.repeat(ths, counts)),
                     pa.array(arrays[0]), *(pa.array(a.astype(np.int32)) for a in arrays[1:4]),
                     pa.array(arrays[4]), pa.array(arrays[5])],
                    names=["_id", "_th", "node", "at", "lo", "hi", "before", "after"],
                )

    texts = docs.select(*row_key(id_col, text_col), text_of(text_col).alias("_text"))
    schema = "_id long, _th long, node long, at int, lo int, hi int, before long, after long"
    return written(texts.mapInArrow(sample, schema), "graph-places")


def first_holders(places: DataFrame, key: str, more: list[Column] | None = None) -> DataFrame:
    """Keys that several document ids have, with a place in the first of these documents.

    Both ``min_by`` see the same rows in the same order, so they speak of the same place.
    """
    return (
        places.groupBy(key)
        .agg(
            F.min("_id").alias("source_id"),
            F.min_by("_th", "_id").alias("source_th"),
            F.min_by(F.col("at").cast("long"), "_id").alias("source_at"),
            F.max("_id").alias("_last"),
            F.count("*").alias("_weight"),
            *(more or []),
        )
        .where("source_id < _last").drop("_last")
    )


def joined_nodes(places: DataFrame) -> DataFrame:
    """The places of nodes in several documents, with source and whether their ways are single."""
    ways = [(F.min(c) == F.max(c)).alias(name)
            for c, name in (("before", "one_in"), ("after", "one_out"))]
    nodes = first_holders(places, "node", ways)
    found = hot_key_join(
        places.select("_id", "_th", "node", "at", "lo", "hi"), nodes, "node", "_weight", "_id"
    )
    return found.where("source_id IS NOT NULL").drop("_weight", "node")


def reaches(owner: np.ndarray, f: dict[str, np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """How far left and right of each node all documents that hold it agree.

    Places are sorted by document and position. A node with one way in is preceded by the same node
    everywhere, so one goes on from there; a node with several ways ends the path.
    """
    index = np.arange(len(owner))
    begins = np.append(True, owner[1:] != owner[:-1])
    ends = np.append(begins[1:], True)
    stop = np.maximum.accumulate(np.where(begins | ~f["one_in"], index, 0))
    left = np.where(f["one_in"][stop], 0, f["at"][stop])
    stop = np.where(ends | ~f["one_out"], index, len(index) - 1)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    right = np.where(f["one_out"][stop], np.iinfo(np.int64).max, f["at"][stop] + size)
    return left, right


def merged(owner: np.ndarray, at: np.ndarray, n: np.ndarray, *same: np.ndarray):
    """Neighbouring ranges of one owner whose other fields agree as one: first index and length."""
    if not len(owner):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    joins = (owner[1:] == owner[:-1]) & (at[1:] == at[:-1] + n[:-1])
    joins = reduce(np.logical_and, (s[1:] == s[:-1] for s in same), joins)
    first = np.nonzero(np.append(True, ~joins))[0]
    return first, np.add.reduceat(n, first)


def sorted_places(lists: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The fields of all list elements, by list and place, each place once, and their lists."""
    inner = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    fields = {inner.type.field(i).name: inner.field(i).to_numpy(zero_copy_only=False)
              for i in range(inner.type.num_fields)}
    order = np.lexsort((fields["at"], owner))
    owner, fields = owner[order], {name: values[order] for name, values in fields.items()}
    new = np.append(True, (owner[1:] != owner[:-1]) | (fields["at"][1:] != fields["at"][:-1]))
    new = new[: len(owner)]
    return owner[new], {name: values[new] for name, values in fields.items()}


def ranges(keys: pa.RecordBatch, owner: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Rows of ranges with the key of the document that each belongs to."""
    ids, ths = (keys.column(c).to_numpy()[owner] for c in ("_id", "_th"))
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(np.int64)) for c in (ids, ths, *columns)], names=["_id", "_th", *SPAN]
    )


RANGES = "_id long, _th long, at long, n long, source_id long, source_th long, source_at long"
# In place of a source, for windows that the paths do not decide.
OPEN = -1


def decided_windows(found: DataFrame, window: int, size: int) -> DataFrame:
    """Ranges of windows that repeat an earlier document, and open ones (``source_at`` is -1).

    The window that a node rules is decided if it lies within what all holders of the node share:
    then the first of them is the first document with that window.
    """

    def decide(batches):
        for batch in batches:
            for part in slices(batch):
                owner, f = sorted_places(part.column("_places"))
                if not len(owner):
                    continue
                left, right = reaches(owner, f, size)
                start = np.maximum(f["lo"], left)
                stop = np.minimum(f["hi"], right - window)
                none = start > stop
                start, stop = np.where(none, f["hi"] + 1, start), np.where(none, f["hi"], stop)
                mine = part.column("_id").to_numpy()[owner]
                later = (start <= stop) & (f["source_id"] < mine)
                shift = f["source_at"] - f["at"]
                o, at, n = owner[later], start[later], (stop - start + 1)[later]
                same = [f["source_id"][later], f["source_th"][later], shift[later]]
                first, n = merged(o, at, n, *same)
                yield ranges(part, o[first], at[first], n, same[0][first], same[1][first],
                             at[first] + same[2][first])
                o = np.concatenate((owner, owner))
                at = np.concatenate((f["lo"], stop + 1))
                n = np.concatenate((start, f["hi"] + 1)) - at
                order = np.lexsort((at, o))
                order = order[n[order] > 0]
                o, at, n = o[order], at[order], n[order]
                first, n = merged(o, at, n)
                zeros = np.zeros(len(first), dtype=np.int64)
                yield ranges(part, o[first], at[first], n, zeros, zeros, zeros + OPEN)

    place = F.struct(*[F.col(c).cast("long").alias(c) for c in ("at", "lo", "hi")],
                     "source_id", "source_th", "source_at", "one_in", "one_out")
    grouped = found.groupBy("_id", "_th").agg(F.collect_list(place).alias("_places"))
    return written(grouped.mapInArrow(decide, RANGES), "graph-ranges")


def texts_with(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_text`` beside the wanted rows (``_id``, ``_th``, ...), shuffling no other text."""
    texts = docs.select(*row_key(id_col, text_col), text_of(text_col).alias("_text"))
    return texts.where(is_marked(wanted)).join(wanted, ["_id", "_th"])


def open_windows(
    docs: DataFrame, found: DataFrame, id_col: str, text_col: str, window: int
) -> DataFrame:
    """Edges of ``window`` words for the windows that reach over a branch."""

    def hash_windows(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, 64):
                owner, starts, keys = [], [], []
                for row, (text, places) in enumerate(zip(binary(part.column("_text")),
                                                         part.column("_open").to_pylist())):
                    runs = RunHashes(words_in(text), hashes)
                    at = np.concatenate([np.arange(p["at"], p["at"] + p["n"]) for p in places])
                    owner.append(np.full(len(at), row))
                    starts.append(at)
                    keys.append(signed(runs.of(at, at + window)))
                owner = np.concatenate(owner or [np.empty(0, np.int64)])
                ids, ths = (part.column(c).to_numpy()[owner] for c in ("_id", "_th"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(ths), pa.array(np.concatenate(starts or [owner])),
                     pa.array(np.concatenate(keys or [owner]))],
                    names=["_id", "_th", "at", "edge"],
                )

    places = found.where(F.col("source_at") == OPEN).groupBy("_id", "_th").agg(
        F.collect_list(F.struct("at", "n")).alias("_open")
    )
    texts = texts_with(docs, written(places, "graph-open"), id_col, text_col)
    return written(texts.mapInArrow(hash_windows, "_id long, _th long, at long, edge long"),
                   "graph-edges")


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, window: int, size: int) -> DataFrame:
    """Longest ranges of windows with one source, per document, not verified yet."""
    places = graph_places(docs, id_col, text_col, window, size)
    found = decided_windows(joined_nodes(places), window, size)
    edges = open_windows(docs, found, id_col, text_col, window)
    repeats = hot_key_join(edges, first_holders(edges, "edge"), "edge", "_weight", "_id")
    single = repeats.where("source_id < _id").select(
        "_id", "_th", "at", F.lit(1).cast("long").alias("n"), "source_id", "source_th", "source_at"
    )

    def merge(batches):
        for batch in batches:
            for part in slices(batch):
                owner, f = sorted_places(part.column("_spans"))
                first, n = merged(owner, f["at"], f["n"], f["source_id"], f["source_th"],
                                  f["source_at"] - f["at"])
                yield ranges(part, owner[first], f["at"][first], n, f["source_id"][first],
                             f["source_th"][first], f["source_at"][first])

    spans = found.where(F.col("source_at") != OPEN).unionByName(single)
    grouped = spans.groupBy("_id", "_th").agg(F.collect_list(F.struct(*SPAN)).alias("_spans"))
    return written(grouped.mapInArrow(merge, RANGES), "graph-spans")


def words_digest(words: list[bytes], at: int, n: int, window: int) -> bytes:
    """Digest of the words under ``n`` windows from ``at`` on."""
    run = b" ".join(words[at : at + n + window - 1])
    return hashlib.blake2b(run, digest_size=16).digest()


def with_source_digests(
    docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, window: int
) -> DataFrame:
    """The spans per document, each with the digest of the words at its source's place.

    A place that many documents repeat is looked up once, and each source's text is sent once.
    """
    request = F.struct("source_id", "source_th", "source_at", "n")
    asked = spans.groupBy(request.alias("_request")).agg(F.count("*").alias("_weight"))
    asked = written(asked, "graph-requests")
    places = asked.groupBy(F.col("_request.source_id").alias("_id"),
                           F.col("_request.source_th").alias("_th")).agg(
        F.collect_list(F.struct(F.col("_request.source_at").alias("at"), F.col("_request.n"),
                                "_weight")).alias("_asked")
    )

    def digest(batches):
        for batch in batches:
            for part in slices(batch, 64):
                made = []
                for key, th, text, places in zip(part.column("_id").to_pylist(),
                                                 part.column("_th").to_pylist(),
                                                 binary(part.column("_text")),
                                                 part.column("_asked").to_pylist()):
                    words = words_in(text)
                    made += [{"_request": {"source_id": key, "source_th": th,
                                           "source_at": p["at"], "n": p["n"]},
                              "_weight": p["_weight"],
                              "_digest": words_digest(words, p["at"], p["n"], window)}
                             for p in places]
                yield pa.RecordBatch.from_pylist(made, schema=arrow)

    arrow = pa.schema([
        ("_request", pa.struct([(c, LONG) for c in ("source_id", "source_th", "source_at", "n")])),
        ("_weight", LONG), ("_digest", pa.binary()),
    ])
    kind = "struct<source_id:long,source_th:long,source_at:long,n:long>"
    texts = texts_with(docs, written(places, "graph-asked"), id_col, text_col)
    # A repeated row answers twice, alike.
    digests = texts.mapInArrow(digest, f"_request {kind}, _weight long, _digest binary").groupBy(
        "_request").agg(F.first("_weight").alias("_weight"), F.first("_digest").alias("_digest"))
    checked = hot_key_join(spans.withColumn("_request", request), digests, "_request", "_weight", "_id")
    return written(
        checked.groupBy("_id", "_th")
        .agg(F.sort_array(F.collect_list(F.struct("at", "n", "_digest"))).alias("_spans"))
        .select("_id", "_th", *[F.col(f"_spans.{c}").alias(f"_{c.strip('_')}")
                                for c in ("at", "n", "_digest")]),
        "graph-verified",
    )


def cut_words(window: int):
    """An Arrow UDF: the text without the words under verified spans, and their number."""

    @F.arrow_udf("text string, n long")
    def cut(text: pa.Array, at: pa.Array, n: pa.Array, digest: pa.Array) -> pa.Array:
        texts, counts = [], []
        for raw, *spans in zip(binary(text), *(c.to_pylist() for c in (at, n, digest))):
            if spans[0] is None or raw is None:
                texts.append(raw)
                counts.append(0)
                continue
            bounds = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
            words = [raw[a:b] for a, b in bounds]
            gone = np.zeros(len(words) + 1, dtype=bool)
            for start, size, expected in zip(*spans):
                if words_digest(words, start, size, window) == expected:
                    gone[start : start + size + window - 1] = True
            turns = np.nonzero(np.diff(gone.astype(np.int8), prepend=0))[0]
            kept, upto = [], 0
            for first, after in zip(turns[::2], turns[1::2]):
                kept.append(raw[upto : bounds[first][0]])
                upto = bounds[after][0] if after < len(words) else bounds[-1][1]
            texts.append(b"".join([*kept, raw[upto:]]))
            counts.append(int(gone.sum()))
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, LONG)],
            names=["text", "n"],
        )

    return cut


def words_column(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda word: word != "")


def drop_repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS
) -> DataFrame:
    """The rows without the words that stand in long passages of documents with a smaller id.

    A word goes if it lies in ``window`` consecutive words that also stand, as the same words, in a
    document with a smaller id; windows are judged on the texts as given. Repetitions within one
    document stay. The white space before a removed run stays, that after it goes. All columns stay;
    ``n_words`` (of the text as given) and ``n_removed`` are added and replace columns of these
    names. Null texts stay null, texts with fewer words than a window stay as they are, a text that
    only repeats others becomes empty or blank. Rows without an id come after all others and
    repeat those, but not each other; rows with the same id do not count as repeating each other,
    whether their texts are equal or not. An empty table gives an empty result.
    """
    size = min(NODE_WORDS, max(window // 3, 1))
    rows = without(docs, ADDED)
    spans = repeated_spans(rows, id_col, text_col, window, size)
    verified = with_source_digests(rows, spans, id_col, text_col, window)
    keyed = packed(rows, id_col, text_col)
    marked = is_marked(verified)
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in
               (("_at", "array<long>"), ("_n", "array<long>"), ("_digest", "array<binary>"))]
    text = F.col("_row").getField(text_col)
    cut = cut_words(window)(text.cast("string"), "_at", "_n", "_digest")
    changed = keyed.where(marked).join(verified, ["_id", "_th"], "left").withColumn("_cut", cut)
    parts = [
        changed.select("_row", F.col("_cut.text").alias("_text"), F.col("_cut.n").alias("_gone")),
        keyed.where(~marked).select("_row", text.alias("_text"), F.lit(0).cast("long").alias("_gone")),
    ]
    total = F.coalesce(F.size(words_column(text)), F.lit(0))
    return parts[0].union(parts[1]).select(
        *[F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c)
          for c in rows.columns],
        F.when(text.isNull(), 0).otherwise(total).cast("long").alias("n_words"),
        F.col("_gone").alias("n_removed"),
    )


def op11_substring_dedup(spark, sf_dir: str) -> DataFrame:
    cleaned = drop_repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.array_join(words_column(text_of()), " ")
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h
  FROM d, unnest(generate_series(1, len(w) - 49)) AS t(i)
), firsts AS (
  SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), gone AS (
  SELECT doc_id, list(DISTINCT i + j) AS places
  FROM windows JOIN firsts USING (h), unnest(generate_series(0, 49)) AS t(j)
  WHERE first < doc_id GROUP BY doc_id
), words AS (
  SELECT doc_id, i, w[i] AS word FROM d, unnest(generate_series(1, len(w))) AS t(i)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words ANTI JOIN (SELECT doc_id, unnest(places) AS i FROM gone) USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

QUERIES = {"op11_substring_dedup": op11_substring_dedup}
ORACLES = {"op11_substring_dedup": ORACLE}
