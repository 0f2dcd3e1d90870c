import __spark_entry__


def test_entry_has_rows(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["k", "accuracy"] and df.count() == 10


def test_queries_are_callable():
    queries, oracle = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert len(queries) > 200 and set(oracle) <= set(queries) and all(map(callable, queries.values()))
