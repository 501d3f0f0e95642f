import os

import pytest

import fixtures as FX
from ledgerlens.plans import analyses as A
from ledgerlens.plans import incremental as I
from ledgerlens.sources import parse_contracts, parse_transactions
from ledgerlens.sources.colocated import open_list, open_sums, store_list, store_sums
from ledgerlens.sources.typed import typed_transactions
from ledgerlens.versioned import current

ANALYSES = [
    (I.top_contracts_by_value, A.top_contracts_by_value),
    (I.monthly_contract_gas, A.monthly_contract_gas),
    (I.average_contract_gas, A.average_contract_gas),
    (I.gas_of_top_contracts_by_value, A.gas_of_top_contracts_by_value),
]


def same(a, b):
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def executed(df) -> str:
    """The plan as it ran, adaptive changes included."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def ledger(spark, lines, tmp_path):
    tx, contracts = parse_transactions(lines(FX.TX_NO_T4)), parse_contracts(lines(FX.CONTRACTS))
    store_sums(typed_transactions(tx), str(tmp_path / "sums"), 4)
    store_list(contracts, str(tmp_path / "list"), 4)
    return tx, contracts, open_sums(spark, str(tmp_path / "sums")), open_list(spark, str(tmp_path / "list"))


def test_the_same_answers_listings_included(ledger):
    tx, contracts, sums, listed = ledger
    same(listed, contracts.select("address"))
    for stored, plain in ANALYSES:
        same(stored(sums, listed), plain(tx, contracts))


def test_no_exchange_below_the_join(spark, ledger):
    _, _, sums, listed = ledger
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for of in (I._contract_values(sums, listed), I.monthly_contract_gas(sums, listed)):
            plan = executed(of)
            assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
            below = plan[min(plan.index(j) for j in ("SortMergeJoin", "ShuffledHashJoin") if j in plan):]
            assert "Exchange" not in below
        assert "Exchange" not in executed(I._contract_values(sums, listed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_address_is_stored_as_its_sums(spark, tmp_path):
    hot = spark.range(30_000, numPartitions=6).selectExpr(
        "IF(id % 3 = 0, '0xhot', concat('0x', id)) AS to_address", "'01-2020' AS month", "cast(1 AS decimal(38,0)) AS value",
        "cast(2 AS decimal(38,0)) AS gas_price", "cast(21000 AS decimal(38,0)) AS gas_int", "21000D AS gas", "cast(null AS string) AS gas_text",
    )
    root = str(tmp_path / "sums")
    store_sums(hot, root, 5)
    sums = open_sums(spark, root)
    assert sums.where("to_address = '0xhot'").select("n").collect() == [(10_000,)]
    assert sums.count() == 20_001
    files = [f for f in os.listdir(f"{root}/data/{current(spark, root)['data']}") if f.endswith(".parquet")]
    assert len(files) == 5  # one a bucket
    store_list(spark.createDataFrame([("0xhot",), ("0xhot",), ("0x1",)], "address string"), str(tmp_path / "list"), 5)
    listed = open_list(spark, str(tmp_path / "list"))
    got = I.top_contracts_by_value(sums, listed, text=True)
    assert [tuple(r) for r in got.collect()] == [("0xhot", "10000"), ("0xhot", "10000"), ("0x1", "1")]


def test_a_new_version_is_opened_and_a_new_session_reads_the_folder(spark, lines, tmp_path):
    root = str(tmp_path / "list")
    store_list(parse_contracts(lines(FX.CONTRACTS)), root, 4)
    first = open_list(spark, root).count()
    store_list(parse_contracts(lines(FX.CONTRACTS[:2])), root, 3)
    assert open_list(spark, root).count() == 1 < first
    spark.sql(f"DROP TABLE ledgerlens_colocated_{current(spark, root)['data']}")
    assert [tuple(r) for r in open_list(spark, root).collect()] == [("0xc1",)]
    with pytest.raises(ValueError):
        open_sums(spark, root)


def test_empty_and_null_addresses(spark, ledger, tmp_path):
    _, _, sums, _ = ledger
    none = spark.createDataFrame([], "address string")
    store_list(none, str(tmp_path / "none"), 4)
    assert I.top_contracts_by_value(sums, open_list(spark, str(tmp_path / "none"))).collect() == []
    store_list(spark.createDataFrame([(None,), ("0xc1",)], "address string"), str(tmp_path / "some"), 4)
    listed = open_list(spark, str(tmp_path / "some"))
    assert listed.count() == 2
    assert [r.address for r in I.top_contracts_by_value(sums, listed).collect()] == ["0xc1"]
