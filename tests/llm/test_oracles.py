import pytest
from oracle import compare

from textloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, name):
    assert compare(spark, sf, QUERIES[name], ORACLES[name]) == ""
