"""Every query with checking SQL gives the same rows as that SQL; the others give rows."""

from dataclasses import replace

import pytest
from checks import compare, duck
from conftest import MEDIUM, SMALL

import __spark_entry__
from reviewmill.catalog import model_queries

QUERIES = __spark_entry__.queries()
# The corpus queries are tested in a folder of their own.
ORACLES = {
    name: sql for name, sql in __spark_entry__.oracle_sql().items()
    if name not in __spark_entry__.CORPUS_ORACLES
}


@pytest.fixture(scope="module")
def duckdb_views():
    return duck(MEDIUM)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duckdb_views, name):
    result = QUERIES[name](spark, MEDIUM).toPandas()
    assert len(result) > 0
    assert compare(result, duckdb_views.sql(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", ["model_logreg", "model_light", "model_ngram_baseline"])
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_the_search_covers_all_grids_and_test_rows(spark, monkeypatch):
    """Eight grid points over three families, and scores of all rows after the last cut."""
    small = replace(model_queries.SEARCH, forest_trees=5, logreg_iterations=5, svc_iterations=5)
    monkeypatch.setattr(model_queries, "SEARCH", small)
    monkeypatch.setattr(model_queries, "_SEARCHES", {})
    grid = QUERIES["cv_results"](spark, SMALL).toPandas()
    assert grid.groupby("model").size().to_dict() == {"logreg": 4, "random_forest": 2, "linear_svc": 2}
    metrics = QUERIES["model_metrics"](spark, SMALL).toPandas().set_index("model")
    assert len(metrics) == 4 and metrics["auc"].between(0, 1).all()
    best = QUERIES["best_model"](spark, SMALL).first()
    assert best.auc == metrics.loc[["logreg", "random_forest", "linear_svc"], "auc"].max()
    scores = QUERIES["predictions"](spark, SMALL).toPandas()
    con = duck(SMALL)
    con.register("scores", scores)
    card = con.sql("""
        SELECT avg((prediction = label)::INT) AS accuracy,
          (SELECT sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END)
             / count(*) FROM scores p, scores n WHERE p.label = 1 AND n.label = 0) AS auc
        FROM scores""").fetchall()[0]
    assert card == pytest.approx((best.accuracy, best.auc))
    again = QUERIES["cv_results"](spark, SMALL).toPandas()
    assert again.equals(grid)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == [
        "product_category", "month_start", "reviews", "avg_stars", "positive_rate",
    ]
    assert result.count() > 0
