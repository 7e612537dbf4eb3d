"""Operators against their SQL over the given tables."""

import pytest

from compare import connect, differences
from retail_stream.llm import queries

MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql(spark, name):
    rows, different = differences(spark, connect(MEDIUM), queries.QUERIES[name], queries.ORACLE_SQL[name], MEDIUM)
    assert different is None and rows > 0


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
