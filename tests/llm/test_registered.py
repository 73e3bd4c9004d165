"""Registered queries with SQL, and the pipeline's stages."""

import pytest

from allelespan.llm import registry
from tests.oracles import connected, same


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    same(spark, connected(sf_dir), registry.queries()[name], registry.oracle_sql()[name], sf_dir)


def test_one_query_for_each_operator():
    numbers = [int(n[2:].split("_")[0]) for n in registry.queries()]
    assert len(numbers) == len(set(numbers)) and set(range(1, 11)) <= set(numbers) <= set(range(1, 14))
