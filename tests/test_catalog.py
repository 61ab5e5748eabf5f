"""Every registered query runs; those with SQL give what DuckDB gives."""

import pytest
from compare import same

from waferlens import catalog

SLOW = {"rf_importance"}


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, data, duck, name):
    same(catalog.QUERIES[name](spark, data).toPandas(), duck.execute(catalog.SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL) - SLOW))
def test_runs(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
