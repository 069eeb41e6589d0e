"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import pytest

import __spark_entry__ as E
from tallyhawk.plans import catalog
from conftest import SF_SMALL
from oracle_harness import compare, duck

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sqls = E.oracle_sql()
    if name not in sqls:
        assert E.queries()[name](spark, SF_SMALL).count() >= 0
        return
    problems, _, _ = compare(spark, con, name, E.queries()[name], sqls[name], SF_SMALL)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    from tallyhawk.operators.fraud import REPORT_COLUMNS
    assert df.columns == REPORT_COLUMNS
    assert df.count() > 0
