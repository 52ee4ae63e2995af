"""Every registered query agrees with its DuckDB oracle on the smallest tables."""

import pytest

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def results(spark):
    from tools.oracle_check import compare
    return compare(spark, SF_SMALL)


def test_all_queries_registered_with_oracles():
    from gridmeter.catalog import oracle_sql, queries
    assert set(queries()) == set(oracle_sql())
    assert len(queries()) >= 40


def test_all_agree(results):
    bad = {k: v for k, v in results.items() if not v.startswith("ok")}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 23  # FIXTURES.md §3 count at sf0.001
    assert df.columns[0] == "dataset_id" and df.columns[-1] == "task_id"
