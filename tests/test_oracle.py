"""Every query that has SQL against DuckDB over the smallest tables."""

import oracle
import pytest

from gleaner.plans import jobs, registry  # noqa: F401 - jobs adds its queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    equal, what = oracle.compare(registry.QUERIES[name](spark, SMALL), con, registry.ORACLE_SQL[name])
    assert equal, what


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_other_queries_run(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
