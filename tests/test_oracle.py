"""Every registered query against its SQL in DuckDB, on whole tables."""

import os

import oracle
import pytest

from tokenloom.catalog import ORACLES, QUERIES

SF_DIR = f"{oracle.TESTDATA}/sf{os.environ.get('TOKENLOOM_SF', '0.001')}"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    assert oracle.compare(spark, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
