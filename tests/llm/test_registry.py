import re

from gapscope.llm.queries import ORACLE, QUERIES


def test_one_query_of_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert ORACLE.keys() <= QUERIES.keys()
