import json

import pytest

import fixtures as FX
from ledgerlens.sources import (
    parse_blocks,
    parse_contracts,
    parse_popular_contracts,
    parse_registry,
    parse_transactions,
    read_legacy_nested_pairs,
    read_legacy_pairs,
    read_transactions,
    registry_addresses,
)
from ledgerlens.sources.ledger import validity_counts


def test_transactions_keep_only_well_formed_rows(lines):
    tx = parse_transactions(lines(FX.TX))
    assert sorted(r.hash for r in tx.collect()) == sorted(FX.TX_KEPT)
    assert len(tx.columns) == 15
    row = {r.hash: r for r in tx.collect()}["0xt3"]
    assert row.to_address == ""  # contract creation keeps an empty key


def test_validity_counts(lines):
    r = validity_counts(lines(FX.TX), "transactions").first()
    assert (r.lines, r.valid, r.dropped) == (11, 6, 5)
    r = validity_counts(lines(FX.CONTRACTS), "contracts").first()
    assert (r.lines, r.valid, r.dropped) == (6, 3, 3)


def test_text_reader_strips_crlf(spark, tmp_path):
    p = tmp_path / "tx.csv"
    p.write_bytes(("\r\n".join(FX.TX) + "\r\n").encode())
    assert read_transactions(spark, str(p)).count() == len(FX.TX_KEPT)


def test_contracts_keep_duplicates_and_exact_flags(lines):
    c = parse_contracts(lines(FX.CONTRACTS))
    assert sorted(r.address for r in c.collect()) == ["0xc1", "0xc1", "0xc4"]


def test_blocks_arity_and_probe(lines):
    b = parse_blocks(lines(FX.BLOCKS))
    nums = sorted(int(r.number) for r in b.collect())
    assert nums == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 16]


def test_registry_explodes_entries_and_addresses(lines):
    reg = parse_registry(lines(FX.REGISTRY))
    assert sorted(r.id for r in reg.collect()) == [1, 2, 3, 4]
    addr = sorted((r.address, r.id) for r in registry_addresses(reg).collect())
    assert addr == [("0xs1", 1), ("0xs1", 2), ("0xs2", 1), ("0xs2", 3)]


def test_registry_fails_loud(lines):
    with pytest.raises(Exception):
        parse_registry(lines(['{"success":true,"result":{"x":{"id":1,'])).collect()
    with pytest.raises(Exception):  # quoted id: FAILFAST type error
        parse_registry(lines(['{"success":true,"result":{"x":{"id":"7","addresses":["a"]}}}'])).collect()
    with pytest.raises(Exception, match="numeric id"):  # missing id
        parse_registry(lines(['{"success":true,"result":{"x":{"addresses":["a"]}}}'])).collect()


def test_popular_contracts(lines):
    p = parse_popular_contracts(lines(["0xaa,8.41554E+25", "0xbb,1.2E+25"])).collect()
    assert sorted((r.address, r.total) for r in p) == [("0xaa", "8.41554E+25"), ("0xbb", "1.2E+25")]
    with pytest.raises(Exception):
        parse_popular_contracts(lines(["0xaa"])).collect()


def test_legacy_result_files_keep_all_digits(spark, tmp_path):
    flat = tmp_path / "q1_count.csv"
    flat.write_text(json.dumps([["08-2015", 85609], ["0xaa", 84155363699941767867374641]]))
    rows = {r.key: r.value for r in read_legacy_pairs(spark, str(flat)).collect()}
    assert rows == {"08-2015": "85609", "0xaa": "84155363699941767867374641"}
    nested = tmp_path / "q4_scam_graph.txt"
    nested.write_text(json.dumps([[["Phishing", "08-2017"], 16709083588073530571339]]))
    r = read_legacy_nested_pairs(spark, str(nested)).first()
    assert (r.category, r.month, r.total) == ("Phishing", "08-2017", "16709083588073530571339")
