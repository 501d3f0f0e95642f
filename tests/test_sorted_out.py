import os

import pytest

import fixtures as FX
from ledgerlens.plans import analyses as A
from ledgerlens.sources import parse_contracts, parse_transactions
from ledgerlens.sources.ledger import validity_counts
from ledgerlens.sources.sorted_out import kept_rows, observed, outcome_counts, rejected_lines, sort_out

NAMES = ("lines", "valid", "wrong_fields", "wrong_probe")


def test_counts_are_observed_in_the_pass_of_the_analysis(spark, lines):
    tx, counts = observed(lines(FX.TX), "transactions")
    got = sorted(map(tuple, A.monthly_value_stats(tx).collect()))
    assert got == sorted(map(tuple, A.monthly_value_stats(parse_transactions(lines(FX.TX))).collect()))
    want = validity_counts(lines(FX.TX), "transactions").first()
    assert (counts.get["lines"], counts.get["valid"]) == (want["lines"], want["valid"])
    assert [counts.get[c] for c in NAMES] == [11, 6, 2, 3]


def test_one_scan_serves_analysis_and_counts(spark, tmp_path):
    (tmp_path / "tx.csv").write_text("\n".join(FX.TX) + "\n")
    tx, _ = observed(spark.read.text(str(tmp_path / "tx.csv")), "transactions")
    plan = A.monthly_value_stats(tx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan


@pytest.mark.parametrize("kind, text, parse", [("transactions", FX.TX, parse_transactions), ("contracts", FX.CONTRACTS, parse_contracts)])
def test_every_line_is_sorted_out_once(spark, lines, tmp_path, kind, text, parse):
    path = str(tmp_path / "sorted")
    sort_out(spark, lines(text), kind, path)
    kept = kept_rows(spark, path, kind)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, parse(lines(text)).collect()))
    rejected = rejected_lines(spark, path, kind).collect()
    assert kept.count() + len(rejected) == len(text)
    arity = text[0].count(",") + 1
    assert all((r.line.count(",") + 1 != arity) == (r.reason == "fields") for r in rejected)
    assert {r.line for r in rejected} <= set(text)
    counts, want = outcome_counts(spark, path, kind).first(), validity_counts(lines(text), kind).first()
    assert (counts.lines, counts.valid, counts.wrong_fields + counts.wrong_probe) == tuple(want)
    with pytest.raises(FileExistsError):
        sort_out(spark, lines(text), kind, path)


def test_kept_columns_are_pruned_and_rejects_not_opened(spark, lines, tmp_path):
    path = str(tmp_path / "sorted")
    sort_out(spark, lines(FX.TX), "transactions", path)
    plan = A.monthly_transaction_count(kept_rows(spark, path, "transactions"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<block_timestamp:string,value:string>" in plan or "ReadSchema: struct<value:string,block_timestamp:string>" in plan or "ReadSchema: struct<block_timestamp:string>" in plan
    assert "outcome" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_empty_null_and_odd_lines(spark, tmp_path):
    odd = spark.createDataFrame([(None,), ("",), (",,,",), ("," * 14,), ("," * 18,)], "value string")
    path = str(tmp_path / "sorted")
    sort_out(spark, odd, "transactions", path)
    assert tuple(outcome_counts(spark, path, "transactions").first()) == (5, 0, 4, 1)
    assert kept_rows(spark, path, "transactions").collect() == []
    none = str(tmp_path / "none")
    sort_out(spark, odd.limit(0), "transactions", none)
    assert os.path.exists(none + "/_SUCCESS")
    assert tuple(outcome_counts(spark, none, "transactions").first()) == (0, 0, 0, 0)
