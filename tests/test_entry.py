"""All registered queries against DuckDB, on the smallest data set."""

import pytest

import __spark_entry__ as entry
from checks import oracle, queries as registry
from checks.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"
#: The training-data queries are tested in tests/llm, if they are there.
QUERIES = registry.registered()
ORACLES = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_everything_is_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_only_the_approximate_queries_have_no_oracle():
    assert set(ORACLES) <= set(QUERIES)
    assert {q for q in QUERIES if q not in ORACLES} == {
        f"high_value_approx_{g}" for g in ("day", "month", "year")
    }


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in ORACLES])
def test_approximate_query(spark, name):
    """About the limit that the exact query finds: the same keys but for a few."""
    exact = QUERIES[name.replace("approx", "analysis")](spark, SF_DIR).drop("high_value_count")
    found = QUERIES[name](spark, SF_DIR).drop("high_value_count")
    assert found.columns == exact.columns
    assert found.exceptAll(exact).count() + exact.exceptAll(found).count() <= 0.2 * exact.count() + 2
