import pytest

from pairloom.plans import registry
from tests.conftest import SF, same_rows


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    same_rows(registry.queries()[name](spark, SF), duck, registry.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_components_of_a_chain_and_a_star(spark):
    from pairloom.operators.graph import connected_components

    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(7000, 7000), (None, 3)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(1000, 1100)} == {1000} and found[7000] == 7000
