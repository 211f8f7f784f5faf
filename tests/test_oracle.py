"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n)))
def test_query_matches_oracle(spark, con, name):
    fn = E.queries()[name]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert fn(spark, SF).count() >= 0
        return
    assert compare(spark, con, SF, name, fn, sql)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
