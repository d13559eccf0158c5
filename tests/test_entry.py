import __spark_entry__ as contract


def test_contract(spark):
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries)
    own = set(queries) - set(contract.TEXT_QUERIES)
    assert own <= set(sql)
    assert contract.entry(spark).count() > 0
