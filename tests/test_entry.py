"""The driver contract in __spark_entry__.py."""
import __spark_entry__ as entry_mod

from martkit.plans.ledger import FACT_COLUMNS
from martkit.plans.queries import REGISTRY


def test_entry_flagship(spark):
    df = entry_mod.entry(spark)
    assert df.columns == FACT_COLUMNS
    first = df.schema.simpleString()
    assert df.count() > 0
    assert entry_mod.entry(spark).schema.simpleString() == first      # stable schema


def test_queries_and_oracles_pair_up():
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    own = set(REGISTRY)
    assert len(own) == 49 and own <= set(qs) and own <= set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values()) and all(isinstance(s, str) and s.strip() for s in sql.values())
