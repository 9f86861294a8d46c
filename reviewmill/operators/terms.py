"""Term statistics of documents as tables: frequencies, TF-IDF, and the n-gram vocabulary."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions.grams import (
    counted,
    hashed_words,
    is_marked,
    marks,
    pairs_in,
    term_hashes,
    worded,
    words_in,
)
from reviewmill.functions.text import STOP_WORDS, tokens_of_lower
from reviewmill.llm.common import number_rows, slices
from reviewmill.operators.joins import frequent_key_join
from reviewmill.operators.ordering import default_buckets
from reviewmill.session import written

# Size of the n-gram vocabulary and the least number of documents for a term.
VOCABULARY_SIZE, MIN_DOCUMENTS = 50_000, 5
# Hashes of terms that a task adds up at once, and terms that it holds to count or name them.
HELD_HASHES, NAMED_TERMS = 2_000_000, 300_000


def _lowered(text: str) -> Column:
    return F.lower(F.col(text)).alias("_text")


def term_rows(documents: DataFrame, key: str, text: str) -> DataFrame:
    """How often each term occurs (``tf``) in the rows of a key, and in how many (``doc_freq``).

    Stop words are left out. Tokens are counted where the document is read. Only the counts of rows that share their key, or
    have none, are shuffled to be added up.
    """
    kind = documents.schema[key].dataType

    def count(batches):
        stop_words = frozenset(STOP_WORDS)
        for batch in batches:
            for part in slices(batch, 128):
                terms, times, rows = [], [], []
                for row, text in enumerate(part.column("_text").to_pylist()):
                    found = Counter(tokens_of_lower(text))
                    own = [term for term in found if term not in stop_words]
                    terms += own
                    times += map(found.__getitem__, own)
                    rows.append(np.full(len(own), row))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.concatenate(rows))),
                        pa.array(terms, pa.string()),
                        pa.array(times, pa.int64()),
                        pa.array(np.ones(len(terms), np.int64)),
                    ],
                    names=[key, "term", "tf", "doc_freq"],
                )

    def counted_rows(rows: DataFrame) -> DataFrame:
        texts = rows.select(F.col(key), _lowered(text)).where("_text IS NOT NULL")
        schema = T.StructType().add(key, kind).add("term", "string").add("tf", "long")
        schema = schema.add("doc_freq", "long")
        return texts.mapInArrow(count, schema)

    repeated = written(
        documents.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
        .where("_rows > 1").select("_key"),
        "repeated-keys",
    )
    if repeated.isEmpty():
        return counted_rows(documents)
    same = F.col(key).eqNullSafe(F.col("_key"))
    shared = counted_rows(documents.join(repeated, same, "left_semi"))
    return counted_rows(documents.join(repeated, same, "left_anti")).union(
        shared.groupBy(key, "term").agg(
            F.sum("tf").alias("tf"), F.sum("doc_freq").alias("doc_freq")
        )
    )


def term_frequencies(documents: DataFrame, key: str, text: str) -> DataFrame:
    """How often each term that is no stop word occurs in each document."""
    return term_rows(documents, key, text).drop("doc_freq")


def document_frequencies(documents: DataFrame, text: str) -> DataFrame:
    """In how many documents each term occurs; counted per task before the one shuffle by term."""

    def count(batches):
        stop_words = frozenset(STOP_WORDS)
        found: Counter = Counter()

        def flushed():
            terms = [term for term in found if term not in stop_words]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(map(found.__getitem__, terms), pa.int64())],
                names=["term", "doc_freq"],
            )
            found.clear()
            return batch

        for batch in batches:
            for part in slices(batch, 128):
                for text in part.column("_text").to_pylist():
                    found.update(set(tokens_of_lower(text)))
                if len(found) > NAMED_TERMS:
                    yield flushed()
        if found:
            yield flushed()

    texts = documents.select(_lowered(text)).where("_text IS NOT NULL")
    partial = texts.mapInArrow(count, "term string, doc_freq bigint")
    return partial.groupBy("term").agg(F.sum("doc_freq").alias("doc_freq"))


def inverse_document_frequencies(
    documents: DataFrame, text: str, frequencies: DataFrame | None = None
) -> DataFrame:
    """ln((documents + 1) / (document frequency + 1)) of each term; frequencies may be known."""
    if frequencies is None:
        frequencies = document_frequencies(documents, text)
    all_documents = documents.agg(F.count("*")).scalar()
    idf = F.log((all_documents + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))
    return frequencies.withColumn("idf", idf)


def tf_idf(documents: DataFrame, key: str, text: str) -> DataFrame:
    """TF-IDF of each term in each document.

    Texts are taken apart once and their terms written. Only those of rarer terms are shuffled to be
    joined.
    """
    rows = written(term_rows(documents, key, text), "terms")
    frequencies = rows.groupBy("term").agg(F.sum("doc_freq").alias("doc_freq"))
    weighted = frequent_key_join(
        rows.drop("doc_freq"),
        inverse_document_frequencies(documents, text, frequencies),
        "term",
        "doc_freq",
    )
    return weighted.select(key, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def word_hashes(documents: DataFrame, text: str, *keep: str) -> DataFrame:
    """The hashes of each text's words in order (``_words``, one binary value), and columns to keep."""

    def take_apart(batches):
        for batch in batches:
            for part in slices(batch, 128):
                found = words_in(part.column("_text"))
                ends = np.searchsorted(found.rows, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], number_rows(found.hashes, ends)],
                    names=[*keep, "_words"],
                )

    texts = documents.select(*keep, F.coalesce(worded(F.col(text)), F.lit("")).alias("_text"))
    schema = T.StructType([documents.schema[name] for name in keep]).add("_words", "binary")
    return texts.mapInArrow(take_apart, schema)


def term_counts(apart: DataFrame, vocabulary: list[str], *keep: str) -> DataFrame:
    """Sparse vectors (``counts``) of how often each term of a vocabulary is in ``word_hashes``."""
    sent = apart.sparkSession.sparkContext.broadcast(term_hashes(vocabulary))
    size = len(vocabulary)

    def count(batches):
        hashes, places = sent.value
        for batch in batches:
            for part in slices(batch, 128):
                found = hashed_words(part.column("_words"))
                at, pairs = pairs_in(found)
                every = np.concatenate([found.hashes, pairs])
                rows = np.concatenate([found.rows, found.rows[at]])
                near = np.minimum(np.searchsorted(hashes, every), max(len(hashes) - 1, 0))
                hit = hashes[near] == every if len(hashes) else np.zeros(len(every), bool)
                keys, n = np.unique(rows[hit] * size + places[near[hit]], return_counts=True)
                ends = pa.array(
                    np.searchsorted(keys, np.arange(part.num_rows + 1) * size).astype(np.int32)
                )
                counts = pa.StructArray.from_arrays(
                    [
                        pa.array(np.zeros(part.num_rows, np.int8)),
                        pa.array(np.full(part.num_rows, size, np.int32)),
                        pa.ListArray.from_arrays(ends, pa.array((keys % size).astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(n.astype(np.float64))),
                    ],
                    names=["type", "size", "indices", "values"],
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], counts], names=[*keep, "counts"]
                )

    schema = T.StructType([apart.schema[name] for name in keep]).add("counts", VectorUDT())
    return apart.select(*keep, "_words").mapInArrow(count, schema)


def _gram_sums(apart: DataFrame, words: bool, marked: np.ndarray | None = None) -> DataFrame:
    """Total and document counts of words, or of pairs of neighbouring marked words, by hash.

    Tasks add up the hashes of many texts before the shuffle, which so carries numbers only.
    """
    sent = apart.sparkSession.sparkContext.broadcast(marked)

    def count(batches):
        keys, rows, held, row = [], [], 0, 0

        def flushed():
            sums = counted(np.concatenate(keys), np.concatenate(rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(sums[0].view(np.int64)), pa.array(sums[1]), pa.array(sums[2])],
                names=["hash", "total", "doc_freq"],
            )

        for batch in batches:
            for part in slices(batch, 128):
                found = hashed_words(part.column("_words"))
                own, places = found.hashes, slice(None)
                if not words:
                    places, own = pairs_in(found)
                    if sent.value is not None:
                        good = is_marked(found.hashes, sent.value)
                        good = good[places] & good[places + 1]
                        places, own = places[good], own[good]
                keys.append(own)
                rows.append(found.rows[places] + row)
                held, row = held + len(own), row + part.num_rows
                if held > HELD_HASHES:
                    yield flushed()
                    keys, rows, held = [], [], 0
        if held:
            yield flushed()

    partial = apart.select("_words").mapInArrow(count, "hash bigint, total bigint, doc_freq bigint")
    return partial.groupBy("hash").agg(
        F.sum("total").alias("total"), F.sum("doc_freq").alias("doc_freq")
    )


def _gram_names(documents: DataFrame, text: str, marked: np.ndarray) -> DataFrame:
    """The marked terms (``hash``, ``term``), each named by one of its occurrences."""
    sent = documents.sparkSession.sparkContext.broadcast(marked)

    def name(batches):
        seen = np.empty(0, np.uint64)
        for batch in batches:
            for part in slices(batch, 128):
                found = words_in(part.column("_text"))
                places, pairs = pairs_in(found)
                every = np.concatenate([found.hashes, pairs])
                at = np.concatenate([np.arange(len(found.hashes)), places])
                hits = np.nonzero(is_marked(every, sent.value))[0]
                new, first = np.unique(every[hits], return_index=True)
                fresh = ~np.isin(new, seen)
                new, first = new[fresh], hits[first[fresh]]
                seen = new if len(seen) > NAMED_TERMS else np.concatenate([seen, new])
                terms = [
                    found.text(at[i]) if i < len(found.hashes)
                    else f"{found.text(at[i])} {found.text(at[i] + 1)}"
                    for i in first.tolist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new.view(np.int64)), pa.array(terms, pa.string())],
                    names=["hash", "term"],
                )

    texts = documents.select(worded(F.col(text)).alias("_text")).where("_text IS NOT NULL")
    named = texts.mapInArrow(name, "hash bigint, term string")
    return named.groupBy("hash").agg(F.min("term").alias("term"))


def _lowest_total(counts: DataFrame, size: int) -> int:
    """The largest total that ``size`` terms reach, from the number of terms per total; 0 if none.

    Texts of n words have fewer than sqrt(4 n) different totals.
    """
    from_the_top = Window.orderBy(F.desc("total")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    per_total = counts.groupBy("total").agg(F.count("*").alias("_terms"))
    reached = per_total.select("total", F.sum("_terms").over(from_the_top).alias("_reached"))
    return reached.where(F.col("_reached") >= size).agg(F.max("total")).first()[0] or 0


def gram_counts(
    documents: DataFrame, text: str, size: int | None = None, min_documents: int = 1,
    apart: DataFrame | None = None,
) -> DataFrame:
    """Total and document counts of one- and two-word terms that are in enough documents.

    With a ``size``, only the terms that reach the total of the ``size``-th are counted, ties with it
    included. A pair is no more frequent than its words, so pairs are counted after words, and only
    those of words that are frequent enough. Terms are told apart by 64-bit hashes, and named last.
    Texts are taken apart once; ``apart`` is their written ``word_hashes``, if a caller has them.
    """
    if apart is None:
        apart = written(word_hashes(documents, text), "word-hashes")
    enough = F.col("doc_freq") >= min_documents
    singles = written(_gram_sums(apart, True).where(enough), "words")
    frequent = None
    if size is not None:
        frequent = marks(singles.where(F.col("total") >= _lowest_total(singles, size)))
    pairs = written(_gram_sums(apart, False, frequent).where(enough), "pairs")
    chosen = singles.union(pairs)
    if size is not None:
        chosen = chosen.where(F.col("total") >= _lowest_total(chosen, size))
    names = _gram_names(documents, text, marks(chosen))
    return chosen.join(names, "hash").select("term", "total", "doc_freq")


def gram_vocabulary(
    documents: DataFrame,
    text: str,
    size: int = VOCABULARY_SIZE,
    min_documents: int = MIN_DOCUMENTS,
    apart: DataFrame | None = None,
) -> DataFrame:
    """The most frequent terms among those that occur in enough documents; ties go by name.

    Terms that are too rare to be among the first ``size`` are left out before anything is sorted, so
    a task never has to sort or merge the whole vocabulary.
    """
    counts = written(gram_counts(documents, text, size, min_documents, apart), "grams")
    return counts.orderBy(F.desc("total"), "term").limit(size)


def category_index(reviews: DataFrame, column: str = "product_category") -> DataFrame:
    """Position of each value by falling frequency, ties by name, as StringIndexer orders labels.

    Values are counted first. Ranges of the whole order are then numbered on their own and shifted by
    the sizes of the ranges before them. They are cut by count and name, so values that occur once,
    often nearly all of them, are spread over many ranges.
    """
    order = [F.desc("reviews"), F.col(column)]
    counts = reviews.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("reviews")
    )
    ranged = written(
        counts.repartitionByRange(default_buckets(counts), *order)
        .withColumn("_range", F.spark_partition_id()),
        "categories",
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy("_range").agg(F.count("*").alias("_values"))
        .select("_range", F.coalesce(F.sum("_values").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(F.broadcast(before), "_range").select(
        column, "reviews", (F.col("_before") + place - 1).cast("int").alias("category_idx")
    )
