import __spark_entry__ as entry_mod
from ratings_engine.plans.registry import all_queries

from tests.conftest import SF_SMALL


def test_entry_runs_and_schema_is_stable(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == entry_mod.entry(spark).columns


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_sql_queries_run_on_smallest_data(spark):
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    for name in all_queries():
        if name not in o:
            continue
        df = q[name](spark, SF_SMALL)
        assert len(df.columns) > 0, name
