"""Registered queries against their SQL on the smallest tables.

Flows and streams have tests of their own; ``oracle_check.py`` runs everything.
"""

import os

import pytest
from oracle_check import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from skybasin.catalog.entries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
SLOW = ("flow_", "stream_", "reseed", "stored_tables")
# The smallest tables hold no alert.
MAY_BE_EMPTY = {"q06", "q06_wide"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in ORACLES if not n.startswith(SLOW)])
def test_query_equals_sql(spark, duck, name):
    found = difference(spark, duck, queries()[name], oracle_sql()[name], SF_DIR)
    assert found is None or (found == "no rows" and name in MAY_BE_EMPTY)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    scores = [row.risk_score for row in rows]
    assert scores == sorted(scores, reverse=True) and len(rows) >= 5
