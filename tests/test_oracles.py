"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

# What SQL cannot express is tested by itself.
NAMES = sorted(contract.oracle_sql(), key=lambda n: n.startswith("stream_"))


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema and first.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, folder, name):
    equal, _, _ = compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], folder)
    assert equal
