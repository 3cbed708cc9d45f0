import pytest
from oracle_check import compare

from parley.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    problems, n, _ = compare(spark, name, queries.QUERIES[name], queries.ORACLE[name], "/root/testdata/sf0.01")
    assert not problems and n > 0
