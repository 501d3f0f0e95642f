import math
from decimal import Decimal

import pytest

import fixtures as FX
from ledgerlens.plans import analyses as A
from ledgerlens.sources import parse_blocks, parse_contracts, parse_registry, parse_transactions

BIG = 84155363699941767867374641


@pytest.fixture
def tx(lines):
    return parse_transactions(lines(FX.TX))


@pytest.fixture
def tx_int_gas(lines):
    return parse_transactions(lines(FX.TX_NO_T4))


@pytest.fixture
def contracts(lines):
    return parse_contracts(lines(FX.CONTRACTS))


@pytest.fixture
def registry(lines):
    return parse_registry(lines(FX.REGISTRY))


@pytest.fixture
def blocks(lines):
    return parse_blocks(lines(FX.BLOCKS))


def test_monthly_stats(tx):
    got = {r.month: (r.n, r.total, r.avg) for r in A.monthly_value_stats(tx).collect()}
    aug_total = BIG + 1 + 7
    assert got["08-2015"][:2] == (3, Decimal(aug_total))
    assert got["08-2015"][2] == float(Decimal(aug_total)) / 3
    assert got["09-2015"] == (3, Decimal(12), 4.0)
    assert set(got) == {"08-2015", "09-2015"}


def test_q01_to_q03_are_projections(tx):
    assert {r.month: r.n for r in A.monthly_transaction_count(tx).collect()} == {"08-2015": 3, "09-2015": 3}
    assert A.monthly_total_value(tx).columns == ["month", "total"]
    assert A.monthly_average_value(tx).columns == ["month", "avg"]


def test_q01_does_not_parse_unused_values(lines):
    bad_value = FX.TX + ["0xt11,0,0xb4,106,0,0xa1,0xc1,not-a-number,21000,1,0x,1441065600,,,0"]
    got = {r.month: r.n for r in A.monthly_transaction_count(parse_transactions(lines(bad_value))).collect()}
    assert got == {"08-2015": 3, "09-2015": 4}
    with pytest.raises(Exception, match="malformed value"):
        A.monthly_total_value(parse_transactions(lines(bad_value))).collect()


def test_q04_top_contracts_keeps_list_multiplicity(tx, contracts):
    got = [(r.address, r.total) for r in A.top_contracts_by_value(tx, contracts).collect()]
    assert got == [("0xc1", Decimal(BIG + 8)), ("0xc1", Decimal(BIG + 8))]


def test_q05_top_miners_tie_break(blocks):
    got = [(r.miner, r.total_size) for r in A.top_miners_by_block_size(blocks, 9).collect()]
    assert got[:8] == [("0xm03", 900), ("0xm04", 800), ("0xm05", 700), ("0xm06", 650),
                       ("0xm07", 640), ("0xm08", 630), ("0xm09", 620), ("0xm10", 610)]
    assert got[8] == ("0xm01", 500)  # tie with 0xm02 broken by address
    rest = {r.miner: r.total_size for r in A.top_miners_by_block_size(blocks, 20).collect()}
    assert rest["0xm11"] == 170 and rest["0xm12"] == 110


def test_q06_average_gas_price(tx):
    got = {r.month: r.avg for r in A.monthly_average_gas_price(tx).collect()}
    assert got == {"08-2015": 100000000002 / 3, "09-2015": 1.0}


def test_q07_monthly_contract_gas(tx_int_gas, contracts):
    got = {r.month: r.gas for r in A.monthly_contract_gas(tx_int_gas, contracts).collect()}
    assert got == {"08-2015": 2 * (21000 + 21000)}


def test_q07_fails_loud_on_float_gas(tx, contracts):
    with pytest.raises(Exception, match="malformed gas"):
        A.monthly_contract_gas(tx, contracts).collect()


def test_q08_average_contract_gas_truncates(tx, contracts):
    r = A.average_contract_gas(tx, contracts).collect()
    assert [(x.label, x.avg) for x in r] == [("Avg gas used", 21000.0)]


def test_q08_no_row_on_empty_join(tx, lines):
    none = parse_contracts(lines(["0xzz,0x60,0xab,True,False,1"]))
    assert A.average_contract_gas(tx, none).collect() == []


def test_q09_gas_of_top_contracts(tx, contracts):
    top = A.top_contracts_by_value(tx, contracts)
    got = [(r.address, r.gas) for r in A.gas_of_top_contracts(tx, top).collect()]
    assert len(got) == 1 and got[0][0] == "0xc1"
    assert got[0][1] == pytest.approx(2 * (21000 + 21000 + 21000.9))


def test_q09_with_popular_list(tx, lines):
    from ledgerlens.sources import parse_popular_contracts

    top = parse_popular_contracts(lines(["0xc1,8.41554E+25"]))
    got = [(r.address, r.gas) for r in A.gas_of_top_contracts(tx, top).collect()]
    assert got[0][0] == "0xc1" and got[0][1] == pytest.approx(63000.9)


def test_q10_block_column_overhead(blocks):
    r = A.block_column_overhead(blocks).collect()
    assert [(x.label, x.bytes) for x in r] == [("Total unnecessary data consumed: ", 13 * 384 + 351 + 352)]


def test_q11_most_lucrative_scam(tx, registry):
    assert [(r.id, r.total) for r in A.most_lucrative_scam(tx, registry).collect()] == [(1, Decimal(12))]
    by_id = {r.id: r.total for r in A.scam_value_by_id(tx, registry).collect()}
    assert by_id == {1: Decimal(12), 2: Decimal(3), 3: Decimal(9)}


def test_q12_scam_value_by_category_month(tx, registry):
    got = sorted((r.category, r.month, r.total) for r in A.scam_value_by_category_month(tx, registry).collect())
    assert got == [("Fake ICO", "09-2015", Decimal(3)), ("Phishing", "09-2015", Decimal(12))]


def test_q13_series(tx):
    monthly = A.monthly_transaction_count(tx)
    assert [(r.ym, r.n) for r in A.chronological_series(monthly).collect()] == [("2015-08", 3), ("2015-09", 3)]
    assert [r.ym for r in A.series_head(monthly, 1).collect()] == ["2015-08"]
    assert [r.ym for r in A.series_tail(monthly, 1).collect()] == ["2015-09"]
    assert A.series_total(monthly).first().total == 6


def test_q13_series_without_label(spark):
    s = spark.createDataFrame([("Phishing", 1), ("Scamming", 2)], "label string, v int")
    assert [r.label for r in A.series_without(s).collect()] == ["Phishing"]


def test_q14_scam_series_pivot(tx, registry):
    p = A.scam_series_pivot(tx, registry)
    assert p.columns == ["ym", "FakeICO", "Phishing", "Scamming"]
    assert [tuple(r) for r in p.collect()] == [("2015-09", Decimal(3), Decimal(12), None)]


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_join_strategies_agree(spark, tx, tx_int_gas, contracts, registry, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r.month: r.gas for r in A.monthly_contract_gas(tx_int_gas, contracts).collect()} == {
        "08-2015": 84000}
    assert [r.avg for r in A.average_contract_gas(tx, contracts).collect()] == [21000.0]
    assert {r.id: r.total for r in A.scam_value_by_id(tx, registry).collect()} == {
        1: Decimal(12), 2: Decimal(3), 3: Decimal(9)}
    got = sorted((r.category, r.month, r.total)
                 for r in A.scam_value_by_category_month(tx, registry).collect())
    assert got == [("Fake ICO", "09-2015", Decimal(3)), ("Phishing", "09-2015", Decimal(12))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_q09_single_pass_equals_chained(tx, contracts):
    fused = {r.address: r.gas for r in A.gas_of_top_contracts_by_value(tx, contracts).collect()}
    chained = {r.address: r.gas for r in
               A.gas_of_top_contracts(tx, A.top_contracts_by_value(tx, contracts)).collect()}
    assert fused == pytest.approx(chained)


def test_empty_to_address_is_a_live_key(tx, lines):
    creation = parse_contracts(lines([",0x60,0xab,False,False,1"]))
    got = [(r.address, r.total) for r in A.contract_value_totals(tx, creation).collect()]
    assert got == [("", Decimal(0))]  # t3, the contract-creation row


def test_registry_entry_without_addresses_vanishes(tx, lines):
    reg = parse_registry(lines([
        '{"success":true,"result":{"a.example":{"id":7,"category":"Phishing","addresses":null},'
        '"b.example":{"id":8,"category":"Phishing","addresses":["0xs1"]}}}'
    ]))
    assert {r.id: r.total for r in A.scam_value_by_id(tx, reg).collect()} == {8: Decimal(3)}


def test_q04_keeps_totals_and_multiplicity(tx, contracts):
    got = [(r.address, r.total) for r in A.top_contracts_by_value(tx, contracts, 10).collect()]
    assert got == [("0xc1", Decimal(BIG + 8)), ("0xc1", Decimal(BIG + 8))]
    fused = {r.address: r.gas for r in A.gas_of_top_contracts_by_value(tx, contracts, 10).collect()}
    assert fused == pytest.approx({"0xc1": 2 * (21000 + 21000 + 21000.9)})


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


def _row(value="1", gas="21000"):
    return f"0xt,0,0xb4,106,0,0xa1,0xc1,{value},{gas},1,0x,1441065600,,,0"


@pytest.mark.parametrize("gas", ["oops", "21000d", "21000f", "0x1p3", "", "1__0", "1_"])
def test_bad_gas_stops_the_job_whatever_the_session_says(lines, contracts, ansi, gas):
    tx = parse_transactions(lines([_row(gas=gas)]))
    for analysis in (A.average_contract_gas, A.monthly_contract_gas, A.gas_of_top_contracts_by_value):
        with pytest.raises(Exception, match="malformed gas"):
            analysis(tx, contracts).collect()


@pytest.mark.parametrize("gas,number", [("1_000", 1000.0), (" 21000.5 ", 21000.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("+7", 7.0)])
def test_float_text_as_python_reads_it(lines, contracts, ansi, gas, number):
    assert float(gas) == number
    tx = parse_transactions(lines([_row(gas=gas)]))
    assert [r.avg for r in A.average_contract_gas(tx, contracts).collect()] == [float(int(number))]
    assert [r.gas for r in A.gas_of_top_contracts_by_value(tx, contracts, 1).collect()] == [number]


def test_a_value_of_39_digits_stops_the_job(lines, ansi):
    tx = parse_transactions(lines([_row(value="1" + "0" * 38), _row(value="5")]))
    with pytest.raises(Exception, match="malformed value"):
        A.monthly_total_value(tx).collect()


@pytest.mark.parametrize("document,message", [
    ('{"success":true}', "without result"),
    ('{"success":true,"result":{"a":{"category":"Phishing","addresses":["0xs1"]}}}', "numeric id"),
    ('{"success":true,"result":{"a":{"id":3,"addresses":["0xs1"]}}}', "without category"),
])
def test_incomplete_registry_stops_both_scam_analyses(tx, lines, ansi, document, message):
    reg = parse_registry(lines([document]))
    for analysis in (A.most_lucrative_scam, A.scam_value_by_category_month):
        with pytest.raises(Exception, match=message):
            analysis(tx, reg).collect()


def test_of_entries_with_one_name_the_last_counts(tx, lines):
    reg = parse_registry(lines(['{"success":true,"result":{"a":{"id":1,"category":"Phishing","addresses":["0xs1"]},'
                                '"b":{"id":2,"category":"Phishing","addresses":[]},'
                                '"a":{"id":9,"category":"Scamming","addresses":["0xs1"]}}}']))
    assert {r.id: r.total for r in A.scam_value_by_id(tx, reg).collect()} == {9: Decimal(3)}


def test_pivot_is_one_aggregate_over_the_join_and_a_sort(tx, registry):
    plan = A.scam_series_pivot(tx, registry)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Join")]
    assert above.count("Exchange rangepartitioning") == 1 and above.count("Exchange hashpartitioning") == 1


def test_gas_sums_do_not_depend_on_the_order_of_rows(lines, contracts):
    big = str(2**53 + 1)
    tx = parse_transactions(lines([_row(gas=big), _row(gas="0.5"), _row(gas="0.5"), _row(gas=big)], partitions=4))
    assert [r.gas for r in A.gas_of_top_contracts(tx, contracts.limit(1)).collect()] == [math.fsum([float(big), 0.5, 0.5, float(big)])]
