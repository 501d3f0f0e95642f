"""Named analyses wired to the supplied tables: (spark, sf_dir) -> DataFrame.

Spark derives raw ledger text from the tables (see
:mod:`ledgerlens.plans.mirrors`), the ordinary readers validate it, and the
validated rows are staged once as typed Parquet; each entry then runs one
analysis on that staging (a few entries read the raw text itself). Exact wei
decimals are rendered as integer text so results compare digit for digit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.plans import analyses as A
from ledgerlens.plans import incremental as I
from ledgerlens.plans import mirrors as M
from ledgerlens.sources.ledger import (
    parse_popular_contracts,
    parse_registry,
    parse_transactions,
    registry_addresses,
    validity_counts,
)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.staged_table(spark, sf_dir, "transactions")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.staged_table(spark, sf_dir, "contracts")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.staged_table(spark, sf_dir, "blocks")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows, one per (address, entry)."""
    return M.staged_table(spark, sf_dir, "registry")


def text_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same transactions straight from the raw text (string columns)."""
    return parse_transactions(M.staged_lines(spark, sf_dir, "transactions"))


# --- Q01-Q14 ---------------------------------------------------------------------------

def q_monthly_transaction_count(spark, d):
    return A.monthly_transaction_count(transactions(spark, d))


def q_monthly_total_value(spark, d):
    return A.monthly_total_value(transactions(spark, d), text=True)


def q_monthly_average_value(spark, d):
    return A.monthly_average_value(transactions(spark, d))


def q_top_contracts_by_value(spark, d):
    return A.top_contracts_by_value(transactions(spark, d), contracts(spark, d), text=True)


def q_top_miners_by_block_size(spark, d):
    return A.top_miners_by_block_size(blocks(spark, d))


def q_monthly_average_gas_price(spark, d):
    return A.monthly_average_gas_price(transactions(spark, d))


def q_monthly_contract_gas(spark, d):
    return A.monthly_contract_gas(transactions(spark, d), contracts(spark, d))


def q_average_contract_gas(spark, d):
    return A.average_contract_gas(transactions(spark, d), contracts(spark, d))


def q_gas_of_top_contracts(spark, d):
    return A.gas_of_top_contracts_by_value(transactions(spark, d), contracts(spark, d))


def q_gas_of_popular_contracts(spark, d):
    popular = parse_popular_contracts(M.staged_lines(spark, d, "popular"))
    return A.gas_of_top_contracts(transactions(spark, d), popular)


def q_block_column_overhead(spark, d):
    return A.block_column_overhead(blocks(spark, d))


def q_most_lucrative_scam(spark, d):
    return A.most_lucrative_scam(transactions(spark, d), registry(spark, d), text=True)


def q_scam_value_by_category_month(spark, d):
    return A.scam_value_by_category_month(transactions(spark, d), registry(spark, d), text=True)


def q_chronological_series(spark, d):
    return A.chronological_series(A.monthly_transaction_count(transactions(spark, d)))


def q_series_head(spark, d):
    return A.series_head(A.monthly_transaction_count(transactions(spark, d)), 10)


def q_series_tail(spark, d):
    return A.series_tail(A.monthly_transaction_count(transactions(spark, d)), 5)


def q_series_total(spark, d):
    return A.series_total(A.monthly_transaction_count(transactions(spark, d)), "n", "total")


def q_average_value_series(spark, d):
    return A.chronological_series(A.monthly_average_value(transactions(spark, d)), value="avg")


def q_gas_price_series(spark, d):
    return A.chronological_series(A.monthly_average_gas_price(transactions(spark, d)), value="avg")


def q_contract_gas_series(spark, d):
    return A.chronological_series(
        A.monthly_contract_gas(transactions(spark, d), contracts(spark, d)), value="gas"
    )


def q_scam_series_pivot(spark, d):
    return A.scam_series_pivot(transactions(spark, d), registry(spark, d), text=True)


def _scam_head(category: str, n: int):
    def query(spark, d):
        return A.scam_series_head(transactions(spark, d), registry(spark, d), category, n, text=True)

    return query


def q_average_value_head(spark, d):
    return A.series_head(A.monthly_average_value(transactions(spark, d)), 5, value="avg")


def q_gas_price_tail(spark, d):
    """Last months of the gas price series, the excluded label left out first."""
    series = A.series_without(A.monthly_average_gas_price(transactions(spark, d)), "month")
    return A.series_tail(series, 5, value="avg")


def q_contract_gas_tail(spark, d):
    series = A.series_without(A.monthly_contract_gas(transactions(spark, d), contracts(spark, d)), "month")
    return A.series_tail(series, 5, value="gas")


def q_categories_without_excluded(spark, d):
    """P6 where it matters: scam values of all categories but the excluded one."""
    return A.series_without(A.scam_value_by_category_month(transactions(spark, d), registry(spark, d), text=True), "category")


# --- results written by the executors and read back ---------------------------------------

def _round_trip(spark, result: DataFrame, name: str, schema: str) -> DataFrame:
    """Write a result as JSON lines into a run folder of its own below the
    shared checkpoint folder, and read it back with an explicit schema."""
    import uuid

    from ledgerlens.session import ensure_checkpoint_dir
    from ledgerlens.sinks import run_folder, write_result
    from ledgerlens.sources import read_result

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/results"
    path = write_result(result, base, name, f"{run_folder()}-{uuid.uuid4().hex[:8]}")
    return read_result(spark, path, schema=schema)


def q_stored_monthly_total(spark, d):
    return _round_trip(spark, A.monthly_total_value(transactions(spark, d), text=True), "monthly_total_value", "month string, total string")


def q_stored_scam_values(spark, d):
    result = A.scam_value_by_category_month(transactions(spark, d), registry(spark, d), text=True)
    return _round_trip(spark, result, "scam_value_by_category_month", "category string, month string, total string")


# --- versions behind a pointer, counts and rejects of the reading pass ----------------------

def _replaced(spark, d, result: DataFrame, name: str) -> DataFrame:
    """A result replaced by its next version, and the current version read."""
    from ledgerlens.versioned import prune, publish_version, read_version

    root = M.stage_folder(spark, d, f"transactions.versions.{name}")
    publish_version(spark, result, root, "parquet")
    prune(spark, root, keep=8)
    return read_version(spark, root)


def q_versioned_contract_values(spark, d):
    return _replaced(spark, d, A.contract_value_totals(transactions(spark, d), contracts(spark, d), text=True), "contract_values")


def q_versioned_scam_values(spark, d):
    return _replaced(spark, d, A.scam_value_by_category_month(transactions(spark, d), registry(spark, d), text=True), "scam_values")


def sorted_out(spark: SparkSession, d: str, kind: str) -> str:
    """Folder of the sorted lines of ``kind``, written by one pass over the text."""
    from ledgerlens.sources.sorted_out import sort_out

    path = M.stage_folder(spark, d, f"{kind}.sorted")
    sort_out(spark, M.staged_lines(spark, d, kind), kind, path, existing="keep")
    return path


def q_observed_validity(spark, d):
    """Line counts of the transactions, observed while Q01-Q03 runs on the raw
    text and is written: one row, with the transactions that Q01 counted."""
    from ledgerlens.sources.sorted_out import observed

    tx, counts = observed(M.staged_lines(spark, d, "transactions"), "transactions")
    stats = _round_trip(spark, A.monthly_value_stats(tx, text=True), "observed_value_stats", "month string, n long, total string, avg double")
    seen = [F.lit(counts.get[c]).cast("bigint").alias(c) for c in ("lines", "valid", "wrong_fields", "wrong_probe")]
    return stats.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")).select(*seen, "n")


def q_sorted_validity(spark, d):
    """Line counts of the three dumps, from the footers of the sorted lines."""
    from ledgerlens.sources.sorted_out import outcome_counts

    one, two, three = (
        outcome_counts(spark, sorted_out(spark, d, kind), kind).select(F.lit(kind).alias("kind"), "*")
        for kind in ("transactions", "contracts", "blocks")
    )
    return one.unionByName(two).unionByName(three)


def q_rejected_transactions(spark, d):
    """First field and reason of every transaction line that is not well-formed."""
    from ledgerlens.sources.sorted_out import rejected_lines

    rejected = rejected_lines(spark, sorted_out(spark, d, "transactions"), "transactions")
    return rejected.select(F.substring_index("line", ",", 1).alias("hash"), "reason")


def q_sorted_contract_gas(spark, d):
    """Q07 on the kept rows of the sorted lines: text columns, pruned."""
    from ledgerlens.sources.sorted_out import kept_rows

    tx, con = (kept_rows(spark, sorted_out(spark, d, kind), kind) for kind in ("transactions", "contracts"))
    return A.monthly_contract_gas(tx, con)


# --- sums and list in buckets of the address ---------------------------------------------

def colocated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Sums per (address, month) and the contract list, stored once and opened:
    in as many buckets as the session has shuffle partitions, or as the staged
    transactions need."""
    from ledgerlens.sources.colocated import bucket_count, open_list, open_sums, store_list, store_sums
    from ledgerlens.versioned import versions

    tx = transactions(spark, d)
    buckets = bucket_count(spark, M.stage_folder(spark, d, "transactions.typed"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums, listed = (M.stage_folder(spark, d, f"{kind}.buckets.{buckets}") for kind in ("transactions", "contracts"))
    if not versions(spark, sums):
        store_sums(tx, sums, buckets)
    if not versions(spark, listed):
        store_list(contracts(spark, d), listed, buckets)
    return open_sums(spark, sums), open_list(spark, listed)


COLOCATED_QUERIES = {
    "colocated_top_contracts_by_value": lambda spark, d: I.top_contracts_by_value(*colocated(spark, d), text=True),
    "colocated_monthly_contract_gas": lambda spark, d: I.monthly_contract_gas(*colocated(spark, d)),
    "colocated_average_contract_gas": lambda spark, d: I.average_contract_gas(*colocated(spark, d)),
    "colocated_gas_of_top_contracts": lambda spark, d: I.gas_of_top_contracts_by_value(*colocated(spark, d)),
}


# --- operator-level checks ------------------------------------------------------------

def q_transaction_validity(spark, d):
    return validity_counts(M.staged_lines(spark, d, "transactions"), "transactions")


def q_contract_validity(spark, d):
    return validity_counts(M.staged_lines(spark, d, "contracts"), "contracts")


def q_block_validity(spark, d):
    return validity_counts(M.staged_lines(spark, d, "blocks"), "blocks")


def q_registry_addresses(spark, d):
    entries = parse_registry(M.staged_lines(spark, d, "registry"))
    return registry_addresses(entries).select("address", "id", "category", "status")


def q_large_registry_addresses(spark, d):
    """The registry's pages as files of one document each, read in splits."""
    from ledgerlens.sinks import publish
    from ledgerlens.sources.large_registry import read_large_registry

    path = M.stage_folder(spark, d, "registry.documents")
    publish(spark, M.staged_lines(spark, d, "registry"), path, "text", existing="keep", options={"maxRecordsPerFile": 1})
    return registry_addresses(read_large_registry(spark, path)).select("address", "id", "category", "status")


def q_block_bytes(spark, d):
    b = blocks(spark, d)
    return b.select(F.col("number").cast("bigint").alias("number"), A.block_column_bytes(b).alias("bytes"))


def q_contract_value_totals(spark, d):
    return A.contract_value_totals(transactions(spark, d), contracts(spark, d), text=True)


def q_scam_value_by_id(spark, d):
    return A.scam_value_by_id(transactions(spark, d), registry(spark, d), text=True)


def q_text_monthly_value_stats(spark, d):
    """Q01-Q03 in one aggregate, straight from the raw transaction text."""
    return A.monthly_value_stats(text_transactions(spark, d), text=True)


def q_streaming_monthly_value_stats(spark, d):
    """Q01-Q03 as a Structured Streaming job over the staged transaction
    files: run to completion (available-now trigger) into one folder per
    epoch, of which the latest is read back. The state is removed afterwards."""
    import uuid

    from ledgerlens.session import ensure_checkpoint_dir
    from ledgerlens.sinks import file_identity, remove
    from ledgerlens.sources import read_result
    from ledgerlens.streaming import latest_epoch, start_monthly_stats_to_files

    M.staged_lines(spark, d, "transactions")  # make sure the files exist
    name = f"ledger_monthly_{uuid.uuid4().hex[:12]}"
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    q = start_monthly_stats_to_files(spark, M.stage_folder(spark, d, "transactions"), f"{root}/out", name, checkpoint=f"{root}/state", available_now=True)
    q.awaitTermination()
    remove(spark, f"{root}/state")
    schema = "month string, n long, total string, avg double"
    if not file_identity(spark, f"{root}/out"):
        return spark.createDataFrame([], schema)
    return read_result(spark, latest_epoch(spark, f"{root}/out"), schema=schema)


# --- from the summary that grows file by file ------------------------------------------

def summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary of the staged transaction files, brought up to date first."""
    from ledgerlens.sources.summary import read_summary, refresh

    M.staged_lines(spark, d, "transactions")  # make sure the files exist
    root = M.stage_folder(spark, d, "transactions.summary")
    refresh(spark, M.stage_folder(spark, d, "transactions"), root)
    return read_summary(spark, root)


SUMMARY_QUERIES = {
    "summary_monthly_value_stats": lambda spark, d: I.monthly_value_stats(summary(spark, d), text=True),
    "summary_monthly_average_gas_price": lambda spark, d: I.monthly_average_gas_price(summary(spark, d)),
    "summary_top_contracts_by_value": lambda spark, d: I.top_contracts_by_value(summary(spark, d), contracts(spark, d), text=True),
    "summary_monthly_contract_gas": lambda spark, d: I.monthly_contract_gas(summary(spark, d), contracts(spark, d)),
    "summary_average_contract_gas": lambda spark, d: I.average_contract_gas(summary(spark, d), contracts(spark, d)),
    "summary_gas_of_top_contracts": lambda spark, d: I.gas_of_top_contracts_by_value(summary(spark, d), contracts(spark, d)),
    "summary_most_lucrative_scam": lambda spark, d: I.most_lucrative_scam(summary(spark, d), registry(spark, d), text=True),
    "summary_scam_value_by_category_month": lambda spark, d: I.scam_value_by_category_month(summary(spark, d), registry(spark, d), text=True),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "monthly_transaction_count": q_monthly_transaction_count,
    "monthly_total_value": q_monthly_total_value,
    "monthly_average_value": q_monthly_average_value,
    "top_contracts_by_value": q_top_contracts_by_value,
    "top_miners_by_block_size": q_top_miners_by_block_size,
    "monthly_average_gas_price": q_monthly_average_gas_price,
    "monthly_contract_gas": q_monthly_contract_gas,
    "average_contract_gas": q_average_contract_gas,
    "gas_of_top_contracts": q_gas_of_top_contracts,
    "gas_of_popular_contracts": q_gas_of_popular_contracts,
    "block_column_overhead": q_block_column_overhead,
    "most_lucrative_scam": q_most_lucrative_scam,
    "scam_value_by_category_month": q_scam_value_by_category_month,
    "chronological_series": q_chronological_series,
    "series_head": q_series_head,
    "series_tail": q_series_tail,
    "series_total": q_series_total,
    "average_value_series": q_average_value_series,
    "gas_price_series": q_gas_price_series,
    "contract_gas_series": q_contract_gas_series,
    "scam_series_pivot": q_scam_series_pivot,
    "fake_ico_series_head": _scam_head("FakeICO", 5),
    "phishing_series_head": _scam_head("Phishing", 10),
    "scamming_series_head": _scam_head("Scamming", 5),
    "average_value_series_head": q_average_value_head,
    "gas_price_series_tail": q_gas_price_tail,
    "contract_gas_series_tail": q_contract_gas_tail,
    "scam_values_without_excluded": q_categories_without_excluded,
    "stored_monthly_total": q_stored_monthly_total,
    "stored_scam_values": q_stored_scam_values,
    "versioned_contract_values": q_versioned_contract_values,
    "versioned_scam_values": q_versioned_scam_values,
    "observed_validity": q_observed_validity,
    "sorted_validity": q_sorted_validity,
    "rejected_transactions": q_rejected_transactions,
    "sorted_contract_gas": q_sorted_contract_gas,
    "transaction_validity": q_transaction_validity,
    "contract_validity": q_contract_validity,
    "block_validity": q_block_validity,
    "registry_addresses": q_registry_addresses,
    "large_registry_addresses": q_large_registry_addresses,
    "block_bytes": q_block_bytes,
    "contract_value_totals": q_contract_value_totals,
    "scam_value_by_id": q_scam_value_by_id,
    "text_monthly_value_stats": q_text_monthly_value_stats,
    "streaming_monthly_value_stats": q_streaming_monthly_value_stats,
    **SUMMARY_QUERIES,
    **COLOCATED_QUERIES,
}
