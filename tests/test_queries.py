"""Every registered query against its SQL over the smallest tables."""

from __future__ import annotations

import os

import pytest
from __spark_entry__ import entry
from oracle import compare, connect

from schemaflow.plans.table_oracles import ORACLES
from schemaflow.plans.table_queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF) > 0


def test_entry(spark):
    assert entry(spark).count() > 0
