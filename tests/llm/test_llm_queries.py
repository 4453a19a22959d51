"""The problems' queries against their SQL on the smallest test tables."""

import os

import pytest

from corpuskit.llm import queries as Q
from tests.test_queries import DATA, check

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_llm_query(spark, name):
    check(spark, name, Q.queries()[name], Q.oracle_sql().get(name))
