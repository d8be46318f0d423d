"""Every query of the ingestion engine against SQL over the same tables."""

from __future__ import annotations

import pytest
from oracle import compare, duck

import __spark_entry__ as contract
from metaingest.samples.oracle import ORACLE
from metaingest.samples.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert compare(result, connection, ORACLE[name]) is None
