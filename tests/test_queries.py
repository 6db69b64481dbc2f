import pytest

from lodestrata.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_oracle(spark, tiny, same, name):
    same(spark, registry.QUERIES[name], registry.ORACLES[name], tiny)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_oracle_runs(spark, tiny, name):
    assert registry.QUERIES[name](spark, tiny).count() > 0
