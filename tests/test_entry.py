"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["graph_id", "id", "label", "nodes_type"]
    assert df.count() == 73  # kept nodes of crit_0 at sf0.001 (FIXTURES.md)


def test_every_graph_query_has_an_oracle():
    """The library's own queries all have SQL; the optional ones only where SQL can express them."""
    from weftgraph.plans import catalog
    assert set(catalog.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())
