import os

import pytest

from sparkloom.llm import catalog

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_queries_run_and_equal_their_sql(spark, name):
    from tests.oracle import compare

    compare(spark, DATA, catalog.queries()[name], catalog.oracle_sql().get(name))
