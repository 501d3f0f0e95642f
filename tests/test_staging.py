"""What staging writes: tables of one's own, small enough to count."""

import os

import pytest

from ledgerlens.plans import mirrors as M
from ledgerlens.plans import registry as R
from ledgerlens.sources import colocated as C
from ledgerlens.versioned import current


@pytest.fixture
def tables(spark, tmp_path):
    n = 600
    spark.range(n).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'O' AS o_orderstatus", "CAST(100 + id AS DOUBLE) AS o_totalprice",
        "TIMESTAMP_NTZ '1995-03-01 00:00:00' AS o_orderdate", "'3-MEDIUM' AS o_orderpriority",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(n).selectExpr(
        "id AS l_orderkey", "id % 11 AS l_partkey", "id % 5 AS l_suppkey", "CAST(1 + id % 4 AS INT) AS l_linenumber", "CAST(1 + id % 9 AS DOUBLE) AS l_quantity",
        "CAST(100 + id AS DOUBLE) AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus",
        "TIMESTAMP_NTZ '1995-03-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(5).selectExpr("id AS s_suppkey", "CAST(id AS INT) AS s_nationkey", "CAST(9500 AS DOUBLE) AS s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def data_files(folder):
    return [f"{folder}/{f}" for f in os.listdir(folder) if f.startswith("part-")]


def local(spark, tables, kind):
    return M.stage_folder(spark, tables, kind).removeprefix("file:")


def test_typed_rows_need_no_files_of_text(spark, tables):
    """the text of blocks is some twenty times what its typed rows take."""
    got = [tuple(r) for r in R.q_top_miners_by_block_size(spark, tables).collect()]
    sizes = {k: sum(100 + i for i in range(k, 600, 7)) for k in range(7)}
    assert got == [(f"0x{k:040d}", t) for k, t in sorted(sizes.items(), key=lambda x: (-x[1], x[0]))]
    assert os.path.isdir(local(spark, tables, "blocks.typed"))
    assert not os.path.exists(local(spark, tables, "blocks"))


@pytest.mark.parametrize("kind", M.UNBROKEN)
def test_typed_rows_are_those_of_the_files(spark, tables, kind):
    built = sorted(r.value for r in M.BUILDERS[kind](spark, tables).collect())
    assert sorted(r.value for r in M.staged_lines(spark, tables, kind).collect()) == built
    assert all(set("\r\n").isdisjoint(v) for v in built)


def test_files_of_text_are_packed_and_short(spark, tables, monkeypatch):
    """text takes a fraction of its length, in files that one task can read."""
    monkeypatch.setattr(M, "LINES_PER_FILE", 100)
    lines = M.staged_lines(spark, tables, "transactions")
    files = data_files(local(spark, tables, "transactions"))
    text = sum(len(r.value) + 1 for r in lines.collect())
    assert all(f.endswith(".txt.gz") for f in files) and len(files) >= 6
    assert sum(map(os.path.getsize, files)) * 3 < text
    gas = sorted(map(tuple, R.SUMMARY_QUERIES["summary_monthly_contract_gas"](spark, tables).collect()))
    assert gas == sorted(map(tuple, R.q_monthly_contract_gas(spark, tables).collect())) and gas


def test_typed_files_are_short(spark, tables, monkeypatch):
    """what one task sums is bounded by the rows of a file, not by bytes of Parquet alone."""
    monkeypatch.setattr(M, "ROWS_PER_FILE", 100)
    R.transactions(spark, tables)
    files = data_files(local(spark, tables, "transactions.typed"))
    assert len(files) >= 6 and all(spark.read.parquet(f).count() <= 100 for f in files)


def test_buckets_grow_with_the_staged_transactions(spark, tables, monkeypatch):
    """the same answers from more buckets, as the session's partitions were before."""
    plain = [sorted(map(tuple, q(spark, tables).collect())) for q in R.COLOCATED_QUERIES.values()]
    monkeypatch.setattr(C, "BUCKET_BYTES", 200)
    held = spark.conf.get(C.PARTITIONS)
    size = sum(map(os.path.getsize, data_files(local(spark, tables, "transactions.typed"))))
    buckets = C.bucket_count(spark, local(spark, tables, "transactions.typed"), int(held))
    assert buckets >= size / 200 > int(held)
    assert [sorted(map(tuple, q(spark, tables).collect())) for q in R.COLOCATED_QUERIES.values()] == plain and all(plain)
    assert current(spark, local(spark, tables, f"transactions.buckets.{buckets}"))["buckets"] == buckets
    assert spark.conf.get(C.PARTITIONS) == held
