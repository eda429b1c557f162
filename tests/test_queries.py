"""Registered queries against their SQL on the smallest data folder."""

import os

import pytest

import __spark_entry__ as entry
from compare import check, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# A cross-section that runs in a few minutes; tests/compare.py runs all of them.
KEYS = ["S1", "S2", "S6", "P3", "P11", "P28", "F3", "J3", "J5", "J9", "J13", "D1", "D2", "D3", "D6", "D11", "A7", "A9", "A16", "W1", "W7", "W10", "W17", "G1", "G7", "G16", "M1", "M6", "U1"]


def test_every_id_is_registered():
    queries, sql = entry.queries(), entry.oracle_sql()
    own = [k for k in queries if k != "pipeline" and not k.startswith("op")]
    assert len(own) == 182 and set(sql) <= set(queries)


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, key):
    _, _, problem = check(spark, connect(SF), key, entry.queries()[key], entry.oracle_sql().get(key), SF)
    assert problem is None, problem
