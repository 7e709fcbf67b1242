"""Every registered query against its SQL in another engine, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import check
from tracklake.testbed.queries import QUERIES

from .conftest import SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return check.duck(SMALL)


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) & set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_parity(spark, con, name):
    assert check.compare(spark, con, SMALL, name).startswith("ok")
