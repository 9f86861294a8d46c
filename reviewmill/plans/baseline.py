"""Baseline classifier: logistic regression on TF-IDF weights of one- and two-word terms."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.text import one_and_two_grams, words
from reviewmill.operators.terms import (
    MIN_DOCUMENTS,
    VOCABULARY_SIZE,
    gram_vocabulary,
    term_counts,
    word_hashes,
)

# Iterations of the solver and the strength of its penalty on the summed loss.
ITERATIONS = 200
PENALTY = 1.0
# A vocabulary must not be empty; no text gives a term with a blank at its end.
NO_TERM = " "


def with_grams(rows: DataFrame, text: str = "review_text") -> DataFrame:
    return rows.withColumn("words", words(F.col(text))).withColumn(
        "grams", one_and_two_grams(F.col("words"))
    )


def fit_baseline(
    train: DataFrame,
    vocabulary_size: int = VOCABULARY_SIZE,
    min_documents: int = MIN_DOCUMENTS,
    iterations: int = ITERATIONS,
) -> PipelineModel:
    """Fit on rows (review_text, label); apply the model to rows with ``with_grams``.

    The term weight is ln((1 + n) / (1 + df)) + 1, which is Spark's weight plus one, and rows are
    scaled to length one. The penalty applies to the sum of the losses, while Spark's applies to
    their mean, hence the division by the number of rows. The vocabulary is counted by the operator
    that does so for any table; at most ``vocabulary_size`` terms come to the driver, and only the
    sparse counts are kept while the model is fitted. Texts are taken apart once, into word hashes that
    serve the vocabulary and the counts, which are those that the model's first stage makes.
    """
    # Cached and not written, so that the solver sums rows in the order of the scan.
    apart = word_hashes(train, "review_text", "label").persist(StorageLevel.MEMORY_AND_DISK)
    found = gram_vocabulary(train, "review_text", vocabulary_size, min_documents, apart).collect()
    terms = [row.term for row in found] or [NO_TERM]
    counter = CountVectorizerModel.from_vocabulary(terms, inputCol="grams", outputCol="counts")
    counts = term_counts(apart, terms, "label")
    counts.persist(StorageLevel.MEMORY_AND_DISK)
    idf = IDF(inputCol="counts", outputCol="idf").fit(counts)
    weights = Vectors.dense(idf.idf.toArray() + 1.0)
    weigh = ElementwiseProduct(scalingVec=weights, inputCol="counts", outputCol="weighted")
    scale = Normalizer(p=2.0, inputCol="weighted", outputCol="features")
    logreg = LogisticRegression(
        maxIter=iterations,
        regParam=PENALTY / counts.count(),
        elasticNetParam=0.0,
        standardization=False,
    )
    model = logreg.fit(scale.transform(weigh.transform(counts)).select("label", "features"))
    counts.unpersist()
    apart.unpersist()
    return PipelineModel([counter, weigh, scale, model])


def score_baseline(model: PipelineModel, rows: DataFrame) -> DataFrame:
    counter, *stages = model.stages
    apart = word_hashes(rows, "review_text", "review_id", "label")
    counts = term_counts(apart, counter.vocabulary, "review_id", "label")
    return PipelineModel(stages).transform(counts).select(
        "review_id", "label", "prediction", "probability", "rawPrediction"
    )
