"""Every registered query against its checking SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import compare  # noqa: E402

from tidemark import catalog  # noqa: E402

DIRECTORY = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="tables are not here")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    ok, note = compare(spark, DIRECTORY, name, QUERIES[name], ORACLES.get(name))
    assert ok, note


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert len(set(QUERIES) - set(ORACLES)) <= 3
