"""Exact length histogram: token totals, quantiles and truncated totals for every context limit.

Texts are reduced to their encoded length where they are read, and only counts per length are
shuffled. Sums over the longer lengths then answer any question about a context limit exactly: with
limit L a text of n tokens gives min(n, L).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.bpe import Vocabulary, default_vocabulary, token_lengths
from reviewmill.llm.common import table
from reviewmill.operators.ordering import running_total
from reviewmill.session import written


def length_histogram(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """How many documents have each encoded length (``n_tokens``, ``n_docs``).

    A null or empty text has length 0. An empty table gives an empty histogram.
    """
    lengths = token_lengths(docs, vocabulary, text_col)
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limit_totals(histogram: DataFrame) -> DataFrame:
    """For each length that occurs, taken as the context limit, what fits and what is cut.

    ``docs_upto`` and ``tokens_upto`` count texts no longer than the limit, ``docs_over`` and
    ``tokens_over`` the longer ones; ``tokens_kept`` is what truncation leaves of all texts and
    ``tokens_cut`` what it removes; ``quantile`` is the share of texts that fit. Between two lengths
    the counts of texts stay and the kept tokens grow by ``docs_over`` per step, so these rows answer
    every limit (``at_limits``). No task sees all lengths: ranges are totalled first.
    """
    sized = written(histogram.withColumn("_tokens", F.col("n_tokens") * F.col("n_docs")), "lengths")
    docs = running_total(sized, "n_tokens", F.col("n_docs"), "docs_upto")
    tokens = running_total(docs, "n_tokens", F.col("_tokens"), "tokens_upto")
    all_docs = F.coalesce(sized.agg(F.sum("n_docs")).scalar(), F.lit(0))
    all_tokens = F.coalesce(sized.agg(F.sum("_tokens")).scalar(), F.lit(0))
    totals = tokens.select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        "docs_upto",
        "tokens_upto",
        (all_docs - F.col("docs_upto")).alias("docs_over"),
        (all_tokens - F.col("tokens_upto")).alias("tokens_over"),
    )
    kept = F.col("tokens_upto") + F.col("context_limit") * F.col("docs_over")
    return totals.withColumns({
        "tokens_kept": kept,
        "tokens_cut": F.col("tokens_upto") + F.col("tokens_over") - kept,
        "quantile": F.col("docs_upto") / (F.col("docs_upto") + F.col("docs_over")),
    })


def at_limits(totals: DataFrame, limits: list[int]) -> DataFrame:
    """Documents that fit and tokens that are kept for any list of limits, in one pass.

    ``totals`` is the result of ``limit_totals``. The result has a row per different limit.
    """
    length = F.col("context_limit")

    def answer(limit: int):
        fits = length <= limit
        docs = F.coalesce(F.sum(F.when(fits, F.col("n_docs"))), F.lit(0))
        tokens = F.coalesce(F.sum(F.when(fits, length * F.col("n_docs"))), F.lit(0))
        over = F.coalesce(F.sum(F.when(~fits, F.col("n_docs"))), F.lit(0))
        return F.struct(
            F.lit(limit).cast("bigint").alias("limit"), docs.alias("docs_upto"),
            (tokens + F.lit(limit) * over).alias("tokens_kept"),
        )

    answers = F.array(*[answer(limit) for limit in sorted(set(limits))])
    return totals.agg(answers.alias("_answers")).select(F.inline("_answers"))


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    return limit_totals(length_histogram(table(spark, sf_dir, "documents"), default_vocabulary()))


QUERIES = {"op8_token_counts": op8_token_counts}
ORACLES: dict[str, str] = {}
