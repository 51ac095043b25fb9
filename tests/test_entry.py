"""The driver contract in __spark_entry__.py."""
import __spark_entry__ as E


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 45
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s for s in o.values())


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "totalprice", "order_year", "acctbal", "nation", "prediction"]
    assert df.count() > 0
