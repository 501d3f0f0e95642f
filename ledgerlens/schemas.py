"""Positional layouts of the raw ledger files.

The raw files are headerless-in-spirit CSV dumps read as text: a row is valid
when it splits on ',' into exactly the expected number of fields and its probe
field parses. Column names follow the dump's documentation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


@dataclass(frozen=True)
class Layout:
    name: str
    columns: tuple[str, ...]
    probe: str

    @property
    def arity(self) -> int:
        return len(self.columns)

    def index(self, column: str) -> int:
        return self.columns.index(column)


# Column order of the dumps (15, 6 and 19 fields).
TRANSACTIONS = Layout(
    "transactions",
    (
        "hash", "nonce", "block_hash", "block_number", "transaction_index",
        "from_address", "to_address", "value", "gas", "gas_price", "input",
        "block_timestamp", "max_fee_per_gas", "max_priority_fee_per_gas",
        "transaction_type",
    ),
    probe="block_number",
)

CONTRACTS = Layout(
    "contracts",
    ("address", "bytecode", "function_sighashes", "is_erc20", "is_erc721", "block_number"),
    probe="is_erc20",
)

BLOCKS = Layout(
    "blocks",
    (
        "number", "hash", "parent_hash", "nonce", "sha3_uncles", "logs_bloom",
        "transactions_root", "state_root", "receipts_root", "miner",
        "difficulty", "total_difficulty", "size", "extra_data", "gas_limit",
        "gas_used", "timestamp", "transaction_count", "base_fee_per_gas",
    ),
    probe="number",
)

# The five block columns a light client can rebuild, hence "removable".
REMOVABLE_BLOCK_COLUMNS = (
    "sha3_uncles", "logs_bloom", "transactions_root", "state_root", "receipts_root",
)

# Scam registry: one JSON object per line, entries keyed by scam name.
SCAM_ENTRY = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("url", StringType()),
        StructField("coin", StringType()),
        StructField("category", StringType()),
        StructField("subcategory", StringType()),
        StructField("description", StringType()),
        StructField("addresses", ArrayType(StringType())),
        StructField("reporter", StringType()),
        StructField("ip", StringType()),
        StructField("status", StringType()),
    ]
)

SCAM_DOCUMENT = StructType(
    [
        StructField("success", BooleanType()),
        StructField("result", MapType(StringType(), SCAM_ENTRY)),
    ]
)

POPULAR_CONTRACTS = StructType(
    [StructField("address", StringType()), StructField("total", StringType())]
)
