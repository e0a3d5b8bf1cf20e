"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as contract
import pytest
from engines import differences, duck

from oracle.sql import ORACLE
from salespect.plans.queries import QUERIES

SF_DIR = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def engine():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, engine, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert differences(frame, engine, ORACLE[name]) == []
