import __spark_entry__


def test_every_oracle_has_a_query():
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and len(oracles) > 50


def test_flagship_is_there():
    assert "unit_counts" in __spark_entry__.queries()
