"""Quality rules from cross-document line frequency, with DataFrame functions only.

Lines that many different documents of one host share (menus, licences, notices) say nothing about
a document. They are removed, and a document of which they made up nearly everything is rejected.
Copies of a document count once, so a text does not become boilerplate by being copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import SPACES, let, packed, row_key, table, text_of, without
from reviewmill.operators.joins import lookup_join
from reviewmill.session import written

# A line is boilerplate if more different documents of its host have it than both limits say.
LIMIT_DOCS = 20
LIMIT_SHARE = 0.08
# A document is depleted if boilerplate held more than this share of its words.
DEPLETED_SHARE = 0.7
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]"
WHITE = " \t\n\x0b\x0c\r"


def words_in(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def repeated_words(words: Column) -> Column:
    """How many words stand in a three-word window that the text holds twice or more.

    Windows are hashed, and the low bits of each hash make room for the window's place. One sort
    then brings equal windows together and still tells where they stand. Neighbours count as equal
    if their full hashes are.
    """

    def from_windows(windows: Column) -> Column:
        mask = _mask(F.size(windows))

        def from_sorted(ordered: Column) -> Column:
            def at(j: Column) -> Column:
                return F.get(windows, F.get(ordered, j).bitwiseAND(mask).cast("int"))

            def repeated(item: Column, j: Column) -> Column:
                own = F.get(windows, item.bitwiseAND(mask).cast("int"))
                return own.eqNullSafe(at(j - 1)) | own.eqNullSafe(at(j + 1))

            places = F.sort_array(
                F.transform(F.filter(ordered, repeated), lambda item: item.bitwiseAND(mask))
            )
            return F.aggregate(
                places,
                F.struct(F.lit(-3).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("n")),
                lambda state, place: F.struct(
                    place.alias("last"),
                    (state["n"] + F.least(F.lit(3), place - state["last"])).alias("n"),
                ),
                lambda state: state["n"],
            )

        tagged = F.transform(
            windows, lambda w, i: w.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("bigint"))
        )
        return let(F.sort_array(tagged), from_sorted)

    def from_hashes(hashes: Column) -> Column:
        windows = F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get(hashes, i + 1), F.get(hashes, i + 2)),
        )
        return let(windows, from_windows)

    return let(F.transform(words, lambda w: F.xxhash64(w)), from_hashes)


def _mask(count: Column) -> Column:
    """As many low bits as the numbers below ``count`` need."""
    return (F.pow(F.lit(2.0), F.length(F.bin(count))) - 1).cast("bigint")


def base_columns(text: str, words: str, lines: str) -> list[Column]:
    """Counts of words, their characters, symbols, duplicate lines and repeated words."""
    with_word = F.filter(lines, lambda line: line.rlike(WORD))
    return [
        F.size(words).cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col(words)).alias("n_repeat_words"),
    ]


def line_key(host: Column, line: Column) -> Column:
    """Hash of host and normalised line; null for a line without a word."""
    trimmed = F.lower(F.btrim(line, F.lit(WHITE)))
    return F.when(F.length(trimmed) > 0, F.xxhash64(host, trimmed))


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One narrow row per document: key, host, base counts, and its lines as hashes with words."""
    texts = docs.select(
        F.col(id_col).alias("_doc"),
        *row_key(id_col, text_col),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("_host"),
        text_of(text_col).alias("_text"),
    )
    split = texts.withColumns({"_words": words_in(F.col("_text")), "_rows": F.split("_text", "\n")})
    narrow = split.select(
        "_doc", "_id", "_th", "_host",
        *base_columns("_text", "_words", "_rows"),
        let(
            F.col("_host"),
            lambda host: F.filter(
                F.transform(
                    "_rows",
                    lambda line: F.struct(
                        line_key(host, line).alias("key"),
                        F.regexp_count(line, F.lit(WORD + "+")).alias("words"),
                    ),
                ),
                lambda line: line["key"].isNotNull(),
            ),
        ).alias("_lines"),
    )
    return written(narrow, "quality-measures")


def frequent_lines(measures: DataFrame, limit_docs: int, limit_share: float) -> DataFrame:
    """Keys of the lines in more different documents of their host than both limits allow."""
    per_host = measures.groupBy("_host").agg(F.count_distinct("_th").alias("_docs"))
    per_line = (
        measures.select("_host", "_th", F.explode("_lines.key").alias("_line"))
        .groupBy("_line")
        .agg(F.max("_host").alias("_host"), F.count_distinct("_th").alias("_with"))
        .where(F.col("_with") > limit_docs)
    )
    return (
        per_line.join(per_host, "_host")
        .where(F.col("_with") > F.col("_docs") * limit_share)
        .select("_line", F.lit(True).alias("_frequent"))
    )


def line_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limit_docs: int = LIMIT_DOCS,
    limit_share: float = LIMIT_SHARE,
    depleted_share: float = DEPLETED_SHARE,
) -> DataFrame:
    """Base counts and verdict of each row, with the keys of the lines to remove.

    ``kept`` is false if the base rules fail or if boilerplate held too many of the words. A null
    text has no words, so the base rules fail; a null host is a host of its own name (empty). Lines
    are compared without case and outer white space. Of rows with the same id and text each gets
    the same result. An empty table gives an empty result. The columns of the input other than the
    id are not in the result, so names cannot clash.
    """
    measures = measured(docs, id_col, text_col, host_col)
    frequent = frequent_lines(measures, limit_docs, limit_share)
    lines = measures.select("_id", "_th", F.explode(F.array_distinct("_lines.key")).alias("_line"))
    removed = (
        lookup_join(lines, frequent, "_line", "_id")
        .where("_frequent")
        .groupBy("_id", "_th")
        .agg(F.collect_set("_line").alias("_removed"))
    )
    judged = measures.join(removed, ["_id", "_th"], "left").withColumn(
        "_removed", F.coalesce("_removed", F.array().cast("array<bigint>"))
    )
    removed_words = F.aggregate(
        F.filter("_lines", lambda line: F.array_contains("_removed", line["key"])),
        F.lit(0).cast("bigint"),
        lambda n, line: n + line["words"],
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return judged.select(
        "_id", "_th", F.col("_doc").alias("doc_id"), "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        removed_words.alias("removed_words"),
        F.col("_removed").alias("removed_lines"),
        (~base_failed & (removed_words <= F.col("n_words") * depleted_share)).alias("kept"),
    )


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    **limits,
) -> DataFrame:
    """The documents that the rules keep, all their columns, without their boilerplate lines.

    A document without such a line keeps its text as it is.
    """
    verdicts = line_quality(docs, id_col, text_col, host_col, **limits)
    kept = verdicts.where("kept").select("_id", "_th", "removed_lines").distinct()
    rows = packed(docs, id_col, text_col).join(kept, ["_id", "_th"])
    text = F.col("_row").getField(text_col)
    host = F.coalesce(F.col("_row").getField(host_col).cast("string"), F.lit(""))
    cleaned = let(
        host,
        lambda name: F.array_join(
            F.filter(
                F.split(text, "\n"),
                lambda line: ~F.coalesce(
                    F.array_contains("removed_lines", line_key(name, line)), F.lit(False)
                ),
            ),
            "\n",
        ),
    )
    new_text = F.when(F.size("removed_lines") > 0, cleaned).otherwise(text)
    return rows.select(
        *[
            (new_text if c == text_col else F.col("_row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )


def op4_line_quality(spark, sf_dir: str) -> DataFrame:
    verdicts = line_quality(table(spark, sf_dir, "documents"))
    return verdicts.drop("_id", "_th", "removed_lines")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')
           AS words
  FROM documents
), windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM t, unnest(generate_series(1, len(words) - 2)) AS s(i)
), twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows
), repeated AS (
  SELECT doc_id, count(DISTINCT i + o) AS n
  FROM twice, (VALUES (0), (1), (2)) AS v(o) WHERE n > 1 GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, md5(text) AS content, unnest(string_split(text, chr(10))) AS line FROM t
), worded AS (
  SELECT *, lower(trim(line, E' \t\n\x0b\x0c\r')) AS norm,
         len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id
), hosts AS (
  SELECT source, count(DISTINCT md5(text)) AS docs FROM t GROUP BY source
), frequent AS (
  SELECT source, norm FROM worded JOIN hosts USING (source) GROUP BY source, norm, docs
  HAVING count(DISTINCT content) > 20 AND count(DISTINCT content) > docs * 0.08
), removed AS (
  SELECT doc_id, sum(n) AS n FROM worded JOIN frequent USING (source, norm) GROUP BY doc_id
), counts AS (
  SELECT t.doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(dups.n, 0) AS n_dup_lines,
         coalesce(repeated.n, 0) AS n_repeat_words,
         coalesce(removed.n, 0)::bigint AS removed_words
  FROM t LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id)
         LEFT JOIN removed USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND removed_words <= n_words * 0.7 AS kept
FROM counts
"""

QUERIES = {"op4_line_quality": op4_line_quality}
ORACLES = {"op4_line_quality": ORACLE}
