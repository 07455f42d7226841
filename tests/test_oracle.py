"""Every SQL-expressible query equals its DuckDB oracle (row multiset, names)."""

import pytest

from tests.conftest import SF_SMALL
from tremor.plans.oracle import oracle_sql
from tremor.plans.verify import compare

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def report(spark):
    return compare(spark, SF_SMALL, NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(report, name):
    r = report[name]
    assert r["columns_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["Year", "Counts", "Avg_Magnitude", "Max_Magnitude"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
