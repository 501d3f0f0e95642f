"""Cross-query invariants on the supplied tables."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables missing")


def rows(name, spark):
    return QUERIES[name](spark, SF).collect()


def test_month_sets_agree(spark):
    months = {r.month for r in rows("monthly_transaction_count", spark)}
    assert months == {r.month for r in rows("monthly_total_value", spark)}
    assert months == {r.month for r in rows("monthly_average_gas_price", spark)}
    assert len(months) == len(rows("chronological_series", spark))


def test_totals_agree(spark):
    n = sum(r.n for r in rows("monthly_transaction_count", spark))
    assert n == rows("series_total", spark)[0].total == rows("transaction_validity", spark)[0].valid
    by_month = sum(r.gas for r in rows("monthly_contract_gas", spark))
    assert by_month == sum(r.gas for r in rows("contract_gas_series", spark))


def test_scam_totals_bound(spark):
    by_id = sum(int(r.total) for r in rows("scam_value_by_id", spark))
    by_cat = sum(int(r.total) for r in rows("scam_value_by_category_month", spark))
    assert 0 < by_cat <= by_id
    best = rows("most_lucrative_scam", spark)[0]
    assert int(best.total) == max(int(r.total) for r in rows("scam_value_by_id", spark))


def test_overhead_is_sum_of_block_bytes(spark):
    per_block = QUERIES["block_bytes"](spark, SF).agg(F.sum("bytes")).first()[0]
    assert rows("block_column_overhead", spark)[0].bytes == per_block


def test_top_contracts_are_the_largest_listed_totals(spark):
    totals = sorted((int(r.total) for r in rows("contract_value_totals", spark)), reverse=True)[:10]
    assert [int(r.total) for r in rows("top_contracts_by_value", spark)] == totals
