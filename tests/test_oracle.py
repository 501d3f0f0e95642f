"""Every registered query against its SQL statement, on the supplied tables."""

import os

import pytest

import __spark_entry__ as E
from ledgerlens.plans.oracle import ORACLE
from ledgerlens.plans.registry import QUERIES
from oracle_util import compare, duck

SF = os.environ.get("LEDGERLENS_TEST_SF", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason=f"{SF} not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    problems, _ = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert not problems, problems


ORDERED = [n for n in sorted(QUERIES) if n.endswith(("_head", "_tail")) or n in (
    "chronological_series", "scam_series_pivot", "average_value_series", "gas_price_series", "contract_gas_series")]


@pytest.mark.parametrize("name", ORDERED)
def test_series_come_in_time_order(spark, con, name):
    """Row by row, as the statement orders them: all months of the tables."""
    got = QUERIES[name](spark, SF)
    months = [r.ym for r in got.collect()]
    assert months == sorted(months) and (months or "scam" in name)
    want = [r[0] for r in con.execute(f"SELECT ym FROM ({ORACLE[name]}) ORDER BY ym").fetchall()]
    assert months == want


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["address", "total"]
    assert 0 < df.count() <= 10
