"""Physical-plan checks: the shapes that matter at scale."""

import io
import os
import re
from contextlib import redirect_stdout

import pytest

import fixtures as FX
from ledgerlens.plans import analyses as A
from ledgerlens.plans.registry import QUERIES
from ledgerlens.sources import parse_contracts, parse_registry, parse_transactions

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def count(node: str, text: str) -> int:
    return len(re.findall(rf"^\(\d+\) {node}\b", text, flags=re.M))


@pytest.fixture
def tx(lines):
    return parse_transactions(lines(FX.TX_NO_T4, partitions=0))


@pytest.fixture
def contracts(lines):
    return parse_contracts(lines(FX.CONTRACTS, partitions=0))


def test_q03_one_aggregate_one_exchange(tx):
    p = plan(A.monthly_average_value(tx))
    assert count("Exchange", p) == 1
    assert count("HashAggregate", p) == 2  # partial + final, no self-join
    assert "Join" not in p


def test_topk_is_bounded(tx, contracts):
    assert "TakeOrderedAndProject" in plan(A.top_contracts_by_value(tx, contracts))


def _below_first_join(p: str) -> str:
    tree = p.split("\n\n")[0].splitlines()
    i = next(i for i, l in enumerate(tree) if "Join" in l)
    return "\n".join(tree[i + 1:])


def test_q07_aggregates_before_the_join(tx, contracts):
    p = plan(A.monthly_contract_gas(tx, contracts))
    # partial + final per (address, month) below the join, then per month above it
    assert count("HashAggregate", p) == 4
    assert "HashAggregate" in _below_first_join(p)


def test_q09_single_scan(tx, contracts):
    p = plan(A.gas_of_top_contracts_by_value(tx, contracts))
    assert "TakeOrderedAndProject" in p or "TakeOrdered" in p
    from ledgerlens.schemas import TRANSACTIONS
    from ledgerlens.sources.ledger import INT_FIELD, line_pattern

    pattern = line_pattern(TRANSACTIONS, INT_FIELD)
    filters = [sec for sec in p.split("\n\n") if re.match(r"\(\d+\) Filter", sec) and pattern in sec]
    assert len(filters) == 1  # the transactions are read and validated once


def test_scam_joins_meet_sums(tx, lines):
    reg = parse_registry(lines(FX.REGISTRY, partitions=0))
    assert "HashAggregate" in _below_first_join(plan(A.scam_value_by_id(tx, reg)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables missing")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables missing")
def test_typed_staging_prunes_columns(spark):
    assert "ReadSchema: struct<month:string>" in plan(QUERIES["monthly_transaction_count"](spark, SF))
    p = plan(QUERIES["top_contracts_by_value"](spark, SF))
    assert "ReadSchema: struct<to_address:string,value:decimal(38,0)>" in p
    assert "ReadSchema: struct<address:string>" in p


@pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables missing")
def test_text_path_reads_only_the_line(spark):
    assert "ReadSchema: struct<value:string>" in plan(QUERIES["text_monthly_value_stats"](spark, SF))
