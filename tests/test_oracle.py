"""Every registered query against its DuckDB twin on sf0.001."""

import pytest

from tests.conftest import SF_SMALL


def _keys():
    import __spark_entry__ as E
    # keys without a twin are checked in test_fitted.py, the text operators in tests/llm
    sql = E.oracle_sql()
    return sorted(k for k in sql if not k.startswith("op") and k != "pipeline")


@pytest.fixture(scope="module")
def duck():
    from homeledger.plans.oracle_check import duck_connection
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E
    from homeledger.plans.oracle_check import compare
    pdf = E.queries()[key](spark, SF_SMALL).toPandas()
    why = compare(pdf, duck.execute(E.oracle_sql()[key]).df())
    assert why is None, why


def test_entry_runs(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"style", "listings", "median_sold_price"}
