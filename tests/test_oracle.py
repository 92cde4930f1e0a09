"""Each registered query against its SQL counterpart, on the smallest of the given data sets."""

from __future__ import annotations

import os

import pytest
from compare import oracle_rows, spark_rows

import __spark_entry__ as contract
from workload.oracle import ORACLE
from workload.registry import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_parity(spark, name):
    df = REGISTRY[name](spark, SF_DIR)
    columns, rows = spark_rows(df)
    expected_columns, expected = oracle_rows(ORACLE[name], SF_DIR)
    assert columns == expected_columns
    assert rows == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0
