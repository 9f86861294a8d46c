"""The table-based category stage against Spark's own, its joins, and saving."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from reviewmill.operators import category_indexer
from reviewmill.operators.category_indexer import CategoryIndexer


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).select(
        "id", F.when(F.col("id") % 9 == 0, None).otherwise(
            F.concat(F.lit("c"), F.col("id") % 17 % 11)).alias("label")
    )


def numbers(frame):
    return {r["id"]: r["number"] for r in frame.select("id", "number").collect()}


@pytest.mark.parametrize("limit", [100_000, 3])
def test_equals_the_driver_side_indexer(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(category_indexer, "MAX_BROADCAST_ROWS", limit)
    model = CategoryIndexer(inputCol="label", outputCol="number").fit(rows)
    spark_model = StringIndexer(inputCol="label", outputCol="number", handleInvalid="keep").fit(rows)
    unseen = rows.union(spark.createDataFrame([(1000, "new"), (1001, "")], "id long, label string"))
    assert model.getOrDefault("small") == (limit > 3)
    made = model.transform(unseen)
    assert made.columns == ["id", "label", "number"]
    assert numbers(made) == numbers(spark_model.transform(unseen))
    attribute = made.schema["number"].metadata["ml_attr"]
    assert (attribute["type"], attribute["num_vals"]) == ("nominal", 12)


def test_saved_stage_keeps_its_table(rows, tmp_path):
    model = Pipeline(stages=[CategoryIndexer(inputCol="label", outputCol="number")]).fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert numbers(again.transform(rows)) == numbers(model.transform(rows))
    assert again.stages[0].uid == model.stages[0].uid


def test_a_table_without_labels(rows):
    empty = rows.where("label IS NULL")
    made = CategoryIndexer(inputCol="label", outputCol="number").fit(empty).transform(rows)
    assert set(numbers(made).values()) == {0.0}
