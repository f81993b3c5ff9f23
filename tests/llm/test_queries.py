import pytest
from duck import compare

from slidemill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    left, right = compare(spark, sf, queries.QUERIES[name], queries.ORACLES[name])
    assert left == right and left


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
