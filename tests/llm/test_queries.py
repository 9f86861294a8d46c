"""Corpus queries with checking SQL give the same rows as that SQL."""

import pytest
from checks import compare, duck
from conftest import MEDIUM

from reviewmill.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, MEDIUM).toPandas()
    assert len(result) > 0
    assert compare(result, duck(MEDIUM).sql(ORACLES[name]).df()) is None
