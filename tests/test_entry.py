import __spark_entry__ as contract


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 15


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) >= 90
