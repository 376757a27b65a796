"""Registered operators against their DuckDB SQL."""

import pytest

from conftest import SF001
from oracle_compare import compare, duck
from peerguard.llm import catalog


def test_oracles_are_of_registered_queries():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF001), name, catalog.QUERIES[name], catalog.ORACLE[name], SF001)
    assert r["status"] == "MATCH", r
