"""The typed staging gives the same answers as the raw text it came from."""

from decimal import Decimal

import pytest

import fixtures as FX
from ledgerlens.plans import analyses as A
from ledgerlens.sources import parse_blocks, parse_contracts, parse_registry, parse_transactions
from ledgerlens.sources.typed import typed_blocks, typed_contracts, typed_registry, typed_transactions


@pytest.fixture
def text(lines):
    return {
        "tx": parse_transactions(lines(FX.TX_NO_T4)),
        "contracts": parse_contracts(lines(FX.CONTRACTS)),
        "registry": parse_registry(lines(FX.REGISTRY)),
        "blocks": parse_blocks(lines(FX.BLOCKS)),
    }


@pytest.fixture
def typed(spark, text, tmp_path):
    out = {}
    for name, fn in [("tx", typed_transactions), ("contracts", typed_contracts),
                     ("registry", typed_registry), ("blocks", typed_blocks)]:
        path = str(tmp_path / name)
        fn(text[name]).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def test_typed_schema(typed):
    types = dict(typed["tx"].dtypes)
    assert types["value"] == "decimal(38,0)" and types["gas_price"] == "decimal(38,0)"
    assert types["block_timestamp"] == "bigint" and types["month"] == "string"
    assert types["gas"] == "double" and types["gas_int"] == "decimal(38,0)" and types["gas_text"] == "string"
    assert dict(typed["blocks"].dtypes)["size"] == "bigint"
    assert set(typed["registry"].columns) == {"address", "id", "category", "status"}


ANALYSES = [
    ("monthly_value_stats", lambda d: A.monthly_value_stats(d["tx"])),
    ("top_contracts", lambda d: A.top_contracts_by_value(d["tx"], d["contracts"])),
    ("miners", lambda d: A.top_miners_by_block_size(d["blocks"])),
    ("gas_price", lambda d: A.monthly_average_gas_price(d["tx"])),
    ("contract_gas", lambda d: A.monthly_contract_gas(d["tx"], d["contracts"])),
    ("popular_gas", lambda d: A.gas_of_top_contracts(d["tx"], d["contracts"])),
    ("avg_gas", lambda d: A.average_contract_gas(d["tx"], d["contracts"])),
    ("top_gas", lambda d: A.gas_of_top_contracts_by_value(d["tx"], d["contracts"])),
    ("overhead", lambda d: A.block_column_overhead(d["blocks"])),
    ("scam_id", lambda d: A.scam_value_by_id(d["tx"], d["registry"])),
    ("scam_cat", lambda d: A.scam_value_by_category_month(d["tx"], d["registry"])),
    ("pivot", lambda d: A.scam_series_pivot(d["tx"], d["registry"])),
]


@pytest.mark.parametrize("name,fn", ANALYSES, ids=[a[0] for a in ANALYSES])
def test_typed_equals_text(text, typed, name, fn):
    a, b = fn(text), fn(typed)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_staging_is_strict(lines, tmp_path):
    bad = FX.TX + ["0xt11,0,0xb4,106,0,0xa1,0xc1,not-a-number,21000,1,0x,1441065600,,,0"]
    with pytest.raises(Exception, match="malformed value"):
        typed_transactions(parse_transactions(lines(bad))).write.parquet(str(tmp_path / "bad"))


def test_scam_totals_on_typed(typed):
    assert {r.id: r.total for r in A.scam_value_by_id(typed["tx"], typed["registry"]).collect()} == {
        1: Decimal(12), 2: Decimal(3), 3: Decimal(9)}


def test_typed_gas_that_is_no_integer_still_stops_monthly_gas(lines):
    typed = typed_transactions(parse_transactions(lines(FX.TX)))  # t4's gas is 21000.9
    contracts = parse_contracts(lines(FX.CONTRACTS))
    with pytest.raises(Exception, match="malformed gas"):
        A.monthly_contract_gas(typed, contracts).collect()
    assert [r.avg for r in A.average_contract_gas(typed, contracts).collect()] == [21000.0]


def test_monthly_gas_plan_on_typed_rows_has_no_regex(typed):
    plan = A.monthly_contract_gas(typed["tx"], typed["contracts"])._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" not in plan and "regexp" not in plan
