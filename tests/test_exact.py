"""Sums in limbs against Python's unbounded integers and correctly rounded floats."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest

import fixtures as FX
from ledgerlens.operators import exact as X
from ledgerlens.plans import analyses as A
from ledgerlens.sources import parse_contracts, parse_transactions
from ledgerlens.sources.typed import typed_transactions


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_whole_sums_of_any_size(spark, ansi):
    rng = random.Random(1)
    rows = [(g, rng.choice([1, -1]) * rng.randrange(10 ** rng.choice([1, 5, 19, 20, 21, 26, 27, 38]))) for g in range(60) for _ in range(rng.randint(1, 6))]
    top = 10**38 - 1
    rows += [(100, top)] * 3 + [(101, -top)] * 4 + [(102, top), (102, -top), (102, -1), (103, 10**26), (103, -1)]
    want = {}
    for g, v in rows:
        want[g] = want.get(g, 0) + v
    df = spark.createDataFrame([(g, Decimal(v)) for g, v in rows], "g int, v decimal(38,0)")
    one = df.groupBy("g").agg(X.exact_sum("v").alias("t"))
    assert {r.g: (r.s, r.d) for r in one.select("g", X.as_text("t").alias("s"), X.as_double("t").alias("d")).collect()} == {g: (str(v), float(v)) for g, v in want.items()}
    order = [r.g for r in one.orderBy(X.order_key("t"), "g").collect()]
    assert order == sorted(want, key=lambda g: (want[g], g))
    again = one.selectExpr("g % 3 AS k", "t").groupBy("k").agg(X.again("t").alias("t")).select("k", X.as_text("t").alias("s"))
    sums = {}
    for g, v in want.items():
        sums[g % 3] = sums.get(g % 3, 0) + v
    assert {r.k: int(r.s) for r in again.collect()} == sums
    small = one.where("g = 102").select(X.as_decimal("t").alias("d"), X.as_long("t").alias("n")).first()
    assert (small.d, small.n) == (Decimal(-1), -1)
    for show, message in ((X.as_decimal, "more than 38 digits: 2"), (X.as_long, "beyond 64 bits: 2")):
        with pytest.raises(Exception, match=message):
            one.where("g = 100").select(show("t")).collect()


def test_float_sums_lose_no_bit(spark, ansi):
    rng = random.Random(2)
    pick = lambda: rng.choice([1, -1]) * rng.choice([rng.random() * 10 ** rng.choice([0, 3, 15, 20, 30, 37]) + 0.001, float(rng.randrange(10**9)), 20999.99999999999, 1e30, 0.5, 0.1])
    rows = [(g, pick()) for g in range(40) for _ in range(rng.randint(1, 6))]
    want = {}
    for g, v in rows:
        want.setdefault(g, []).append(v)
    df = spark.createDataFrame(rows, "g int, v double").groupBy("g").agg(X.exact_float_sum("v").alias("t"))
    got = {r.g: (r.d, r.s) for r in df.select("g", X.as_double("t", True).alias("d"), X.as_text("t", True).alias("s")).collect()}
    for g, v in want.items():
        assert got[g][0] == math.fsum(v) and Fraction(got[g][1]) == sum(map(Fraction, v))


def test_whole_part_is_that_of_python(spark, ansi):
    some = [1e30, -1e30, 20999.99999999999, -0.5, 2.0**63, -(2.0**63), 2.0**100 + 2.0**50, 8.5e37, 1.0, 0.0]
    df = spark.createDataFrame([(v,) for v in some], "v double")
    assert {r.v: int(r.w) for r in df.select("v", X.whole_part("v").alias("w")).collect()} == {v: int(v) for v in some}


@pytest.mark.parametrize("bad", ["1e300", "inf", "nan"])
def test_what_cannot_be_added_stops_the_job(spark, ansi, bad):
    df = spark.createDataFrame([(float(bad),)], "v double")
    with pytest.raises(Exception, match="whole part of 38 digits|too fine to add"):
        df.agg(X.exact_float_sum("v").alias("t")).collect()


def _row(address="0xc1", value="1", gas="21000", ts="1441065600"):
    return f"0xt,0,0xb4,106,0,0xa1,{address},{value},{gas},1,0x,{ts},,,0"


@pytest.fixture(params=["text", "typed"])
def ledger(request, lines):
    def make(rows):
        tx = parse_transactions(lines(rows))
        return tx if request.param == "text" else typed_transactions(tx)

    return make


def test_gas_as_python_reads_it(ledger, lines, ansi):
    contracts = parse_contracts(lines(["0xc1,0x60,0xab,True,False,90"]))
    gas = ["20999.99999999999", "1e30", "21000", "20999.9999999999999999"]
    tx = ledger([_row(gas=g) for g in gas] + [_row(address="0xzz", gas="5.5")])
    total = sum(int(float(g)) for g in gas)
    assert [r.avg for r in A.average_contract_gas(tx, contracts).collect()] == [float(total) / len(gas)]
    want = math.fsum(map(float, gas))
    assert [r.gas for r in A.gas_of_top_contracts(tx, contracts).collect()] == [want]
    assert [r.gas for r in A.gas_of_top_contracts_by_value(tx, contracts).collect()] == [want]


def test_totals_of_more_than_38_digits(ledger, lines, ansi):
    contracts = parse_contracts(lines(["0xc1,0x60,0xab,True,False,90"]))
    huge = "9" * 38
    tx = ledger([_row(value="7"), *[_row(address="0xzz", value=huge)] * 3])
    assert [(r.address, r.total) for r in A.top_contracts_by_value(tx, contracts).collect()] == [("0xc1", Decimal(7))]
    total = 3 * int(huge) + 7
    stats = A.monthly_value_stats(tx, text=True).first()
    assert (stats.n, stats.total, stats.avg) == (4, str(total), float(total) / 4)
    with pytest.raises(Exception, match=f"more than 38 digits: {total}"):
        A.monthly_total_value(tx).collect()


def test_what_is_malformed_waits_for_the_join(ledger, lines, ansi):
    """Gas of monthly contract gas is only looked at where a list has the address."""
    contracts = parse_contracts(lines(["0xc1,0x60,0xab,True,False,90", "0xc1,0x60,0xab,True,False,91"]))
    sound = [_row(), _row(gas="1_000")]
    assert [(r.month, r.gas) for r in A.monthly_contract_gas(ledger([*sound, _row(address="0xzz", gas="5.5"), _row(address="0xzz", gas="oops")]), contracts).collect()] == [("09-2015", 44000)]
    for gas in ("5.5", "oops", "1e3"):
        with pytest.raises(Exception, match=f"malformed gas: {gas}"):
            A.monthly_contract_gas(ledger([*sound, _row(gas=gas)]), contracts).collect()
    with pytest.raises(Exception, match="malformed gas: oops"):
        A.average_contract_gas(ledger([*sound, _row(address="0xzz", gas="oops")]), contracts).collect()


def test_a_malformed_time_waits_too(lines, ansi):
    contracts = parse_contracts(lines(FX.CONTRACTS))
    rows = [_row(), _row(address="0xzz", ts="never")]
    assert [r.gas for r in A.monthly_contract_gas(parse_transactions(lines(rows)), contracts).collect()] == [42000]
    with pytest.raises(Exception, match="malformed block_timestamp: never"):
        A.monthly_contract_gas(parse_transactions(lines([*rows, _row(ts="never")])), contracts).collect()
