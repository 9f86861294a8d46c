"""Text expressions against Spark's own stages and against plain Python."""

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover, StringIndexer, Tokenizer
from pyspark.sql import functions as F

from reviewmill.functions.text import (
    STOP_WORDS,
    one_and_two_grams,
    space_tokens,
    without_stop_words,
    words,
)
from reviewmill.operators.terms import (
    category_index,
    gram_counts,
    gram_vocabulary,
    inverse_document_frequencies,
    term_frequencies,
    tf_idf,
)
from reviewmill.operators.text_stats import TextStats

TEXTS = ["", " ", "   ", " Hi  there ", "A\tb\nC", "don't STOP the music!!", "a b a b a", "x\\s+y",
         "trailing  ", "Ünïcode ÄÖ 12_3 x"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=" \t\nabcTHE!'", max_size=20), min_size=1, max_size=20))
def test_tokens_and_stop_words_match_the_stages(spark, texts):
    rows = frame(spark, texts + TEXTS)
    staged = StopWordsRemover(inputCol="tok", outputCol="kept", locale="en_US").transform(
        Tokenizer(inputCol="t", outputCol="tok").transform(rows)
    )
    tokens = space_tokens(F.col("t"))
    for row in staged.select("*", tokens.alias("a"), without_stop_words(tokens).alias("b")).collect():
        assert row.a == row.tok
        assert row.b == row.kept


def test_stop_words_are_sparks(spark):
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def expected_grams(text):
    found = re.findall(r"\b\w\w+\b", text.lower())
    return found + [f"{a} {b}" for a, b in zip(found, found[1:])]


def test_words_and_grams(spark):
    rows = frame(spark, TEXTS).select("t", one_and_two_grams(words(F.col("t"))).alias("g"))
    for row in rows.collect():
        assert row.g == expected_grams(row.t)


def test_gram_counts_match_brute_force(spark):
    texts = ["red red blue", "blue red", "", "red", "green blue red red"]
    totals = Counter(g for t in texts for g in expected_grams(t))
    documents = Counter(g for t in texts for g in set(expected_grams(t)))
    rows = gram_counts(frame(spark, texts), "t").collect()
    assert {r.term: (r.total, r.doc_freq) for r in rows} == {
        g: (totals[g], documents[g]) for g in totals
    }
    top = gram_vocabulary(frame(spark, texts), "t", size=2, min_documents=2).collect()
    assert [r.term for r in top] == ["red", "blue"]
    for size in range(1, 9):
        found = gram_vocabulary(frame(spark, texts), "t", size=size, min_documents=1).collect()
        assert [r.term for r in found] == sorted(totals, key=lambda g: (-totals[g], g))[:size]


def test_tf_idf_matches_brute_force(spark):
    texts = ["red red blue", "blue red", "the", "red  x"]
    rows = frame(spark, texts)
    idf = {r.term: r.idf for r in inverse_document_frequencies(rows, "t").collect()}
    assert idf["red"] == pytest.approx(0.22314355131420976)
    assert "the" not in idf and "" in idf
    weights = {(r.id, r.term): r.tfidf for r in tf_idf(rows, "id", "t").collect()}
    counts = term_frequencies(rows, "id", "t").collect()
    assert weights == {(r.id, r.term): r.tf * idf[r.term] for r in counts}


def test_text_stats(spark):
    rows = frame(spark, ["", "Hi THERE! ok!!", " a  b"]).union(
        spark.createDataFrame([(9, None)], "id int, t string")
    )
    stats = TextStats(inputCol="t", outputPrefix="x_").transform(rows).collect()
    found = [(r.x_token_count, r.x_char_count, r.x_exclaim_count, r.x_upper_ratio) for r in stats]
    assert found == [(1, 0, 0, 0.0), (3, 14, 3, 6 / 14), (3, 5, 0, 0.0), (1, 0, 0, 0.0)]


def test_text_stats_defaults_and_literal_pattern(spark):
    assert TextStats().getInputCol() == "review_text"
    literal = TextStats(inputCol="t", tokenPattern=r"\\s+").transform(frame(spark, ["a b c", "a\\sb"]))
    assert [r.txt_token_count for r in literal.collect()] == [1, 2]


def test_text_stats_survives_saving(spark, tmp_path):
    TextStats(inputCol="t", outputPrefix="y_").write().overwrite().save(str(tmp_path / "s"))
    loaded = TextStats.load(str(tmp_path / "s"))
    assert loaded.output_columns()[0] == "y_token_count"
    assert loaded.getInputCol() == "t"


def test_category_index_matches_the_indexer(spark):
    names = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["z", "y"] + [None]
    rows = spark.createDataFrame([(n,) for n in names], "product_category string")
    labels = StringIndexer(
        inputCol="product_category", outputCol="i", handleInvalid="keep"
    ).fit(rows).labels
    found = category_index(rows).orderBy("category_idx").collect()
    assert [r.product_category for r in found] == labels
    assert [r.category_idx for r in found] == list(range(5))


ODD = ["b a b a c", None, "", "x_1 Étéİ ΣΣ d9,a b", "a-b ab cd ab cd", "\U0001d54f y ab cd\nab"]


def test_gram_counts_leave_out_pairs_of_rare_words(spark):
    common, rare = ["ab cd ef"] * 6, ["rr ss", "rr ss tt"]
    rows = frame(spark, common + rare)
    found = {r.term: (r.total, r.doc_freq) for r in gram_counts(rows, "t", 3, 1).collect()}
    assert found == {g: (6, 6) for g in ["ab", "cd", "ef", "ab cd", "cd ef"]}
    assert {r.term for r in gram_counts(rows, "t", None, 3).collect()} == set(found)


def test_grams_of_odd_texts_are_those_of_the_columns(spark):
    rows = spark.createDataFrame(list(enumerate(ODD)), "id int, t string")
    every = rows.select(F.explode(one_and_two_grams(words(F.col("t")))).alias("term"))
    totals = Counter(r.term for r in every.collect())
    assert {r.term: r.total for r in gram_counts(rows, "t").collect()} == totals
    for size in (1, 2, 4, len(totals), 99):
        found = gram_vocabulary(rows, "t", size=size, min_documents=1).collect()
        assert [r.term for r in found] == sorted(totals, key=lambda g: (-totals[g], g.encode()))[:size]


def test_term_rows_of_repeated_and_missing_keys(spark):
    texts = ["a b  red", "red", "red x", None, "\t", "x X ", "red"]
    keys = [1, 1, 2, 3, 4, None, None]
    rows = spark.createDataFrame(list(zip(keys, texts)), "id int, t string")
    found = {(r.id, r.term): r.tf for r in term_frequencies(rows, "id", "t").collect()}
    assert found == {(1, "b"): 1, (1, ""): 1, (1, "red"): 2, (2, "red"): 1, (2, "x"): 1,
                     (None, "x"): 2, (None, "red"): 1}
    idf = {r.term: (r.doc_freq, r.idf) for r in inverse_document_frequencies(rows, "t").collect()}
    assert {t: n for t, (n, _) in idf.items()} == {"b": 1, "": 1, "red": 4, "x": 2}
    weights = {(r.id, r.term): r.tfidf for r in tf_idf(rows, "id", "t").collect()}
    assert weights == {k: tf * idf[k[1]][1] for k, tf in found.items()}


def test_facts_of_frequent_keys_are_not_shuffled(spark, monkeypatch):
    from reviewmill.operators import joins

    monkeypatch.setattr(joins, "HOT_SHARE", 0.2)
    facts = spark.createDataFrame([(i, "ab"[i > 6]) for i in range(8)] + [(9, None)], "id int, k string")
    lookup = spark.createDataFrame([("a", 7, 1.0), ("b", 1, 2.0)], "k string, n long, v double")
    joined = joins.frequent_key_join(facts, lookup, "k", "n")
    assert sorted((r.id, r.v) for r in joined.collect()) == [(i, 1.0 + (i > 6)) for i in range(8)]
