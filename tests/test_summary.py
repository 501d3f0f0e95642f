"""The summary that grows file by file: equal to a full run after every step."""

import os
import random

import pytest

import fixtures as X
from ledgerlens.plans import analyses as A
from ledgerlens.plans import incremental as I
from ledgerlens.sources import parse_contracts, parse_registry, parse_transactions
from ledgerlens.sources import summary as S
from ledgerlens.sources.typed import typed_transactions


@pytest.fixture
def folders(tmp_path):
    dumps = tmp_path / "dumps"
    dumps.mkdir()
    return dumps, str(tmp_path / "summary")


def lists(lines):
    return parse_contracts(lines(X.CONTRACTS)), parse_registry(lines(X.REGISTRY))


def answers(source, module, contracts, registry):
    out = {
        "stats": module.monthly_value_stats(source, text=True),
        "price": module.monthly_average_gas_price(source),
        "top": module.top_contracts_by_value(source, contracts, text=True),
        "average": module.average_contract_gas(source, contracts),
        "top_gas": module.gas_of_top_contracts_by_value(source, contracts),
        "scam": module.most_lucrative_scam(source, registry, text=True),
        "category": module.scam_value_by_category_month(source, registry, text=True),
    }
    return {k: sorted(map(tuple, df.collect()), key=str) for k, df in out.items()}


def agree(spark, lines, dumps, root, gas=True):
    contracts, registry = lists(lines)
    tx = parse_transactions(spark.read.text(str(dumps)))
    summary = S.read_summary(spark, root)
    assert answers(summary, I, contracts, registry) == answers(tx, A, contracts, registry)
    if gas:
        a, b = (sorted(map(tuple, m.monthly_contract_gas(s, contracts).collect())) for m, s in ((I, summary), (A, tx)))
        assert a == b


def write(path, rows):
    path.write_text("\n".join(rows) + ("\n" if rows else ""))


def row(k, to, value, gas="21000", at=1441065600):
    return f"0xr{k},0,0xb1,{k},0,0xa1,{to},{value},{gas},7,0x,{at},,,0"


def test_files_come_change_and_go(spark, lines, folders):
    dumps, root = folders
    assert S.refresh(spark, str(dumps), root) == 0
    assert S.read_summary(spark, root).count() == 0
    write(dumps / "a b.csv", X.TX_NO_T4)
    write(dumps / "empty.csv", [])
    assert S.refresh(spark, str(dumps), root) == 1  # an empty file counts as none
    agree(spark, lines, dumps, root)
    assert S.refresh(spark, str(dumps), root) == 0  # the same files again
    # 38-digit values overflow a decimal sum; one address takes a third of all rows.
    rng = random.Random(2)
    rows = [row(k, rng.choice(["0xc1", f"0xc{k % 5}", f"0xs{k % 3}"]), "9" * 37 if k % 50 == 0 else k, rng.choice(["21000", "5e4"[:1]]), 1438918233 + k * 86400) for k in range(300)]
    write(dumps / "c.csv", rows)
    before = set(os.listdir(f"{root}/sums"))
    assert S.refresh(spark, str(dumps), root) == 1
    new = (set(os.listdir(f"{root}/sums")) - before).pop()
    read = spark.read.parquet(f"{root}/sums/{new}").select("file").distinct().collect()
    assert [r.file.rsplit("/", 1)[1] for r in read] == ["c.csv"]  # the new file alone was read
    agree(spark, lines, dumps, root)
    write(dumps / "c.csv", rows[:150])  # a replay replaces its sums
    assert S.refresh(spark, str(dumps), root) == 1
    agree(spark, lines, dumps, root)
    (dumps / "a b.csv").unlink()
    assert S.refresh(spark, str(dumps), root) == 1
    agree(spark, lines, dumps, root)
    write(dumps / "a b.csv", X.TX_NO_T4)  # and back again
    assert S.refresh(spark, str(dumps), root) == 1
    agree(spark, lines, dumps, root)


def test_gas_that_is_no_integer_waits_for_its_reader(spark, lines, folders):
    dumps, root = folders
    contracts, _ = lists(lines)
    write(dumps / "a.csv", [row(1, "0xc1", 5), row(2, "0xother", 5, "20999.99999999999"), row(3, "0xother", 5, "1e30")])
    S.refresh(spark, str(dumps), root)
    agree(spark, lines, dumps, root)
    write(dumps / "b.csv", [row(4, "0xother", 5, "none")])
    S.refresh(spark, str(dumps), root)
    summary = S.read_summary(spark, root)
    assert I.monthly_contract_gas(summary, contracts).count() == 1  # unlisted
    assert I.monthly_value_stats(summary).first().n == 4  # does not look at gas
    with pytest.raises(Exception, match="malformed gas: none"):
        I.average_contract_gas(summary, contracts).collect()
    write(dumps / "b.csv", [row(4, "0xc1", 5, "5.5")])
    S.refresh(spark, str(dumps), root)
    summary = S.read_summary(spark, root)
    agree(spark, lines, dumps, root, gas=False)
    with pytest.raises(Exception, match="malformed gas: 5.5"):
        I.monthly_contract_gas(summary, contracts).collect()


def test_a_refresh_that_dies_or_meets_another_changes_nothing(spark, lines, folders, monkeypatch):
    dumps, root = folders
    write(dumps / "a.csv", X.TX_NO_T4)
    S.refresh(spark, str(dumps), root)
    write(dumps / "b.csv", [row(1, "0xc1", 5)])
    real, calls = S.publish, []

    def dies(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(S, "publish", dies)
    with pytest.raises(KeyboardInterrupt):
        S.refresh(spark, str(dumps), root)
    assert sum(r.n for r in S.read_summary(spark, root).collect()) == len(X.TX_KEPT) - 1

    def meets_another(*args, **kwargs):
        if not calls:  # another refresh of the same files takes the ordinal first
            calls.append(1)
            monkeypatch.setattr(S, "publish", real)
            assert S.refresh(spark, str(dumps), root) == 1
        return real(*args, **kwargs)

    monkeypatch.setattr(S, "publish", meets_another)
    assert S.refresh(spark, str(dumps), root) == 0  # found nothing left to do
    agree(spark, lines, dumps, root)


def test_malformed_values_stop_the_refresh(spark, folders):
    dumps, root = folders
    write(dumps / "a.csv", [row(1, "0xc1", "5.5")])
    with pytest.raises(Exception, match="malformed value"):
        S.refresh(spark, str(dumps), root)


def test_exchanges_carry_sums(spark, lines):
    typed = typed_transactions(parse_transactions(lines(X.TX_NO_T4)))
    plan = S.summarize(typed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
