"""The driver contract."""

import __spark_entry__ as E


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["visit_year", "visit_month", "visit_count", "avg_duration_days", "month_rank"]
    assert df.count() == 21


def test_every_oracle_has_a_query():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(qs) - set(oracle) <= set(E.LLM_QUERIES)
