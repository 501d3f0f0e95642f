"""Typed, validated ledgers: parse the raw text once, analyse many times.

The raw dumps are text, so every analysis over them reads whole lines. For
repeated analysis the validated rows are staged once as typed Parquet: exact
``decimal(38,0)`` wei, ``bigint`` timestamps and sizes, the UTC month label.
Later analyses then read only the columns they use (column pruning and
predicate pushdown reach the Parquet scan).

Staging is strict: a malformed value in a staged column stops the staging
job, whereas the text path only fails the analyses that use that column. Gas is
the exception, since one analysis only looks at gas that reaches a contract:
``gas_int`` is what integer text says, ``gas`` what Python's ``float()`` reads,
each null where the text is none, and ``gas_text`` is the text itself where it
is no integer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import WEI, double_or_null, flag_to_bool, int_or_null, month_label, strict_int, wei
from ledgerlens.schemas import REMOVABLE_BLOCK_COLUMNS
from ledgerlens.sources.ledger import registry_addresses


def typed_transactions(tx: DataFrame, carry=()) -> DataFrame:
    ts = strict_int(F.col("block_timestamp"), "bigint", "block_timestamp")
    gas = int_or_null(F.col("gas"), WEI)
    return tx.select(
        "to_address",
        "from_address",
        wei(F.col("value"), "value").alias("value"),
        double_or_null(F.col("gas")).alias("gas"),
        gas.alias("gas_int"),
        F.when(gas.isNull(), F.coalesce("gas", F.lit("null"))).alias("gas_text"),
        wei(F.col("gas_price"), "gas_price").alias("gas_price"),
        ts.alias("block_timestamp"),
        month_label(ts).alias("month"),
        *carry,
    )


def typed_contracts(contracts: DataFrame) -> DataFrame:
    return contracts.select(
        "address",
        flag_to_bool(F.col("is_erc20")).alias("is_erc20"),
        "is_erc721",
        "block_number",
    )


def typed_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        strict_int(F.col("number"), "bigint", "number").alias("number"),
        "miner",
        strict_int(F.col("size"), "bigint", "size").alias("size"),
        *REMOVABLE_BLOCK_COLUMNS,
    )


def typed_registry(registry: DataFrame) -> DataFrame:
    """Registry entries exploded to one row per (address, entry)."""
    return registry_addresses(registry).select("address", "id", "category", "status")
