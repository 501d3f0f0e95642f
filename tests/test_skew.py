"""A hot address holding a third of all transactions: results stay exact
whichever join adaptive execution picks, and no plan shuffles raw rows by the hot key."""

import io
import re
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import analyses as A
from ledgerlens.sources import parse_contracts, parse_registry, parse_transactions

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(N)
    to = F.when(F.col("id") % 3 == 0, F.lit("0xhot")).otherwise(F.concat(F.lit("0xa"), (F.col("id") % 500).cast("string")))
    value = (F.col("id") * 1000003).cast("string")
    ts = (F.lit(1438918233) + F.col("id") * 997).cast("string")
    line = F.concat_ws(",", F.lit("0xh"), F.lit("0"), F.lit("0xb"), F.col("id").cast("string"), F.lit("0"),
                       F.lit("0xf"), to, value, F.lit("21000"), F.lit("7"), F.lit("0x"), ts, F.lit(""), F.lit(""), F.lit("0"))
    tx = parse_transactions(ids.select(line.alias("value")).repartition(8))
    contracts = parse_contracts(spark.createDataFrame(
        [("0xhot,0x60,0xab,True,False,1",), ("0xhot,0x60,0xab,True,False,2",), ("0xa7,0x60,0xab,False,False,3",)],
        "value string"))
    registry = parse_registry(spark.createDataFrame(
        [('{"success":true,"result":{"h.example":{"id":1,"category":"Phishing","addresses":["0xhot","0xa7"]}}}',)],
        "value string"))
    return tx, contracts, registry


def hot_total():
    return sum(i * 1000003 for i in range(0, N, 3))


def a7_total():
    return sum(i * 1000003 for i in range(N) if i % 3 and i % 500 == 7)


@pytest.fixture(params=["-1", "10m"])
def threshold(spark, request):
    """Without broadcasts, and with them."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, request.param)
    yield request.param
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_address_totals(skewed, threshold):
    tx, contracts, registry = skewed
    got = sorted((r.address, r.total) for r in A.contract_value_totals(tx, contracts).collect())
    assert got == [("0xa7", Decimal(a7_total())), ("0xhot", Decimal(hot_total())), ("0xhot", Decimal(hot_total()))]
    by_id = {r.id: r.total for r in A.scam_value_by_id(tx, registry).collect()}
    assert by_id == {1: Decimal(hot_total() + a7_total())}
    gas = sum(r.gas for r in A.monthly_contract_gas(tx, contracts).collect())
    assert gas == 21000 * (2 * (N // 3) + len([i for i in range(N) if i % 3 and i % 500 == 7]))


PLANS = {
    "contract_value_totals": lambda tx, con, reg: A.contract_value_totals(tx, con),
    "monthly_contract_gas": lambda tx, con, reg: A.monthly_contract_gas(tx, con),
    "average_contract_gas": lambda tx, con, reg: A.average_contract_gas(tx, con),
    "gas_of_top_contracts_by_value": lambda tx, con, reg: A.gas_of_top_contracts_by_value(tx, con),
    "gas_of_top_contracts": lambda tx, con, reg: A.gas_of_top_contracts(tx, con),
    "scam_value_by_id": lambda tx, con, reg: A.scam_value_by_id(tx, reg),
    "scam_value_by_category_month": lambda tx, con, reg: A.scam_value_by_category_month(tx, reg),
    "scam_series_pivot": lambda tx, con, reg: A.scam_series_pivot(tx, reg),
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_raw_shuffle_by_address(skewed, threshold, name):
    """Every exchange keyed by an address carries partial sums, never raw rows."""
    buf = io.StringIO()
    with redirect_stdout(buf):
        PLANS[name](*skewed).explain(mode="formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0].splitlines()
    by_address = [m.group(1) for m in re.finditer(
        r"^\((\d+)\) Exchange\n(?:[^\n]+\n)*?Arguments: hashpartitioning\(to_address", text, flags=re.M)]
    assert by_address
    for node in by_address:
        i = next(i for i, line in enumerate(tree) if line.rstrip().endswith(f"Exchange ({node})"))
        assert "HashAggregate" in tree[i + 1]


def test_building_a_plan_starts_no_job(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    for build in PLANS.values():
        build(*skewed)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
