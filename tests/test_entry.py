import __spark_entry__ as e


def test_registry():
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) > 60


def test_flagship(spark, sf):
    assert e.entry(spark).count() > 0
