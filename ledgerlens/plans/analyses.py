"""The named ledger analyses, over parsed ledger DataFrames.

Inputs are the string-typed frames returned by :mod:`ledgerlens.sources`;
each analysis casts only what it uses, strictly. Sums are exact, whatever their
size (:mod:`ledgerlens.operators.exact`): totals are ``decimal(38,0)``, or with
``text=True`` decimal text, which also holds what has more than 38 digits;
averages are ``double``, one rounding of the exact sum over the count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType

from ledgerlens.functions.columns import (
    WEI,
    fault_code,
    fault_text,
    hex_byte_count,
    hex_digit_count,
    int_or_null,
    is_truthy_text,
    label_to_ym,
    month_label,
    must,
    squash_spaces,
    strict_int,
    to_double,
    wei,
)
from ledgerlens.operators.aggregate import global_sum, ratio, sum_by
from ledgerlens.operators.exact import again, as_decimal, as_double, as_long, as_text, exact_float_sum, exact_sum, order_key, whole_part
from ledgerlens.operators.join import COUNT, FAULT, FLOAT, WHOLE, join_then_aggregate, members_join
from ledgerlens.operators.member_filter import may_be_listed
from ledgerlens.operators.order import chronological, first_n, last_n, top_k
from ledgerlens.schemas import REMOVABLE_BLOCK_COLUMNS
from ledgerlens.sources.ledger import registry_addresses

# Result labels and the categories charted by the scam series.
AVG_GAS_LABEL = "Avg gas used"
OVERHEAD_LABEL = "Total unnecessary data consumed: "
SERIES_CATEGORIES = ("FakeICO", "Phishing", "Scamming")
EXCLUDED_SERIES_LABEL = "Scamming"


# Inputs are either the raw readers' string frames or the typed staging
# (sources.typed): typed columns are used as they are, text is parsed strictly.

def _tx_month(tx: DataFrame) -> F.Column:
    if "month" in tx.columns:
        return F.col("month")
    return month_label(_long(tx, "block_timestamp"))


def _wei(df: DataFrame, name: str) -> F.Column:
    if isinstance(df.schema[name].dataType, DecimalType):
        return F.col(name)
    return wei(F.col(name), name)


def _long(df: DataFrame, name: str) -> F.Column:
    if isinstance(df.schema[name].dataType, (LongType, IntegerType)):
        return F.col(name).cast("bigint")
    return strict_int(F.col(name), "bigint", name)


def _gas_or_fault(tx: DataFrame) -> tuple[F.Column, F.Column]:
    """Gas that must be integer text, and what is wrong with it where it isn't."""
    if "gas_int" in tx.columns:
        return F.col("gas_int"), fault_code(1, F.col("gas_int"), F.col("gas_text"))
    gas = int_or_null(F.col("gas"), WEI)
    return gas, fault_code(1, gas, F.col("gas"))


def _month_or_fault(tx: DataFrame) -> tuple[F.Column, F.Column]:
    if "month" in tx.columns:
        return F.col("month"), F.lit(None).cast(WEI)
    seconds = int_or_null(F.col("block_timestamp"))
    return month_label(seconds), fault_code(2, seconds, F.col("block_timestamp"))


def _gas_float(tx: DataFrame) -> F.Column:
    """Gas read as a float."""
    if "gas_int" in tx.columns:
        return F.coalesce(F.col("gas"), F.raise_error(F.concat(F.lit("malformed gas: "), F.col("gas_text"))).cast("double"))
    return to_double(F.col("gas"), "gas")


def _shown(total: str, text: bool) -> F.Column:
    return as_text(total) if text else as_decimal(total)


def _registry_rows(registry: DataFrame) -> DataFrame:
    if "address" in registry.columns:  # already one row per (address, entry)
        return registry
    return registry_addresses(registry)


# --- time analysis (Q01-Q03): one scan, one exchange --------------------------------

def monthly_value_stats(tx: DataFrame, text: bool = False) -> DataFrame:
    """month, n (transactions), total (wei), avg (wei) in a single aggregate."""
    rows = tx.select(_tx_month(tx).alias("month"), _wei(tx, "value").alias("value"))
    agg = rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))
    return agg.select("month", "n", _shown("total", text).alias("total"), ratio(as_double("total"), "n").alias("avg"))


def monthly_transaction_count(tx: DataFrame) -> DataFrame:
    return monthly_value_stats(tx).select("month", "n")


def monthly_total_value(tx: DataFrame, text: bool = False) -> DataFrame:
    return monthly_value_stats(tx, text).select("month", "total")


def monthly_average_value(tx: DataFrame) -> DataFrame:
    return monthly_value_stats(tx).select("month", "avg")


# --- popular services and miners (Q04, Q05) ---------------------------------------

def _contract_values(tx: DataFrame, contracts: DataFrame) -> DataFrame:
    """(address, total) per listed contract, the sums still in limbs: summed
    first, then joined with the list and its multiplicity."""
    facts = tx.select("to_address", _wei(tx, "value").alias("value"))
    totals = facts.groupBy("to_address").agg(exact_sum("value").alias("total"))
    joined = members_join(totals, contracts.select("address"), "to_address", "address")
    return joined.select(F.col("to_address").alias("address"), "total")


def contract_value_totals(tx: DataFrame, contracts: DataFrame, text: bool = False) -> DataFrame:
    """Value received per listed contract; one listed twice yields two rows."""
    return _contract_values(tx, contracts).select("address", _shown("total", text).alias("total"))


def top_contracts_by_value(tx: DataFrame, contracts: DataFrame, k: int = 10, text: bool = False) -> DataFrame:
    top = top_k(_contract_values(tx, contracts), k, order_key("total"), "address")
    return top.select("address", _shown("total", text).alias("total"))


def top_miners_by_block_size(blocks: DataFrame, k: int = 10) -> DataFrame:
    sizes = blocks.select("miner", _long(blocks, "size").alias("size"))
    return top_k(sum_by(sizes, "miner", "size", "total_size"), k, "total_size", "miner")


# --- gas (Q06-Q09) ------------------------------------------------------------------

def monthly_average_gas_price(tx: DataFrame) -> DataFrame:
    rows = tx.select(_tx_month(tx).alias("month"), _wei(tx, "gas_price").alias("p"))
    agg = rows.groupBy("month").agg(F.count(F.lit(1)).alias("n"), exact_sum("p").alias("total"))
    return agg.select("month", ratio(as_double("total"), "n").alias("avg"))


def monthly_contract_gas(tx: DataFrame, contracts: DataFrame) -> DataFrame:
    """Gas of transactions sent to listed contracts, per month: summed per
    (address, month), then joined with the list, whose multiplicity counts.
    Gas and time must be integer text, but only where the list has the
    address: what is malformed travels with its group and stops the job if the
    join keeps it."""
    gas, bad_gas = _gas_or_fault(tx)
    month, bad_month = _month_or_fault(tx)
    facts = tx.select("to_address", month.alias("month"), gas.alias("gas"), F.coalesce(bad_gas, bad_month).alias("fault"))
    agg = join_then_aggregate(facts, contracts.select("address"), "to_address", "address", "month",
                              {"gas": ("gas", WHOLE), "fault": ("fault", FAULT)}, pre_keys=["month"])
    sound = agg.where(must(F.col("fault").isNull(), fault_text(F.col("fault"))))
    return sound.select("month", as_long("gas").alias("gas"))


def average_contract_gas(tx: DataFrame, contracts: DataFrame) -> DataFrame:
    """Average gas (float text truncated to an integer) of transactions sent
    to listed contracts; one labelled row, none when nothing joins."""
    facts = tx.select("to_address", _gas_float(tx).alias("gas")).select("to_address", whole_part("gas").alias("gas"), F.lit(1).cast("bigint").alias("n"))
    agg = join_then_aggregate(facts, contracts.select("address"), "to_address", "address", [], {"gas": ("gas", WHOLE), "n": ("n", COUNT)})
    return agg.where(F.col("n") > 0).select(
        F.lit(AVG_GAS_LABEL).alias("label"), ratio(as_double("gas"), "n").alias("avg")
    )


def gas_of_top_contracts_by_value(tx: DataFrame, contracts: DataFrame, k: int = 10) -> DataFrame:
    """Q09 chained on Q04 in one pass over the transactions.

    Value and gas are summed per address in the same aggregate; the top-k
    contracts by value (list multiplicity kept, as in Q04) then carry their
    gas along, and a repeated address adds its gas once per listing.
    """
    facts = tx.select("to_address", _wei(tx, "value").alias("value"), _gas_float(tx).alias("gas"))
    per_addr = facts.groupBy("to_address").agg(exact_sum("value").alias("total"), exact_float_sum("gas").alias("gas"))
    joined = members_join(per_addr, contracts.select("address"), "to_address", "address")
    top = top_k(joined.select(F.col("to_address").alias("address"), "total", "gas"), k, order_key("total"), "address")
    return _gas_as_float(top.groupBy("address").agg(again("gas", floats=True).alias("gas")))


def gas_of_top_contracts(tx: DataFrame, top: DataFrame) -> DataFrame:
    """Total gas per address of a popular list (Q04's result or a stored one;
    repeated addresses multiply): transactions to other addresses leave at the
    scan, the rest is summed exactly per address, then joined. The result is a
    float, like the source's: the one nearest to the sum."""
    facts = _of_members(tx.select("to_address", _gas_float(tx).alias("gas")), "gas", top)
    agg = join_then_aggregate(facts, top.select("address"), "to_address", "address", "to_address", {"gas": ("gas", FLOAT)})
    return _gas_as_float(agg.withColumnRenamed("to_address", "address"))


def _of_members(facts: DataFrame, parsed: str, members: DataFrame) -> DataFrame:
    """The facts whose address a short list may hold. Every fact's number is
    parsed all the same: a malformed one stops the job, listed or not."""
    read = must(F.col(parsed).isNotNull(), F.lit(f"no {parsed}"))
    return facts.where(read & may_be_listed("to_address", members, "address"))


def _gas_as_float(df: DataFrame) -> DataFrame:
    return df.select("address", as_double("gas", floats=True).alias("gas"))


# --- data overhead (Q10) ------------------------------------------------------------

def block_column_bytes(blocks: DataFrame) -> F.Column:
    """Bytes held by the removable columns of one block row."""
    total = None
    for c in REMOVABLE_BLOCK_COLUMNS:
        b = hex_byte_count(F.col(c))
        total = b if total is None else total + b
    return total


def block_column_overhead(blocks: DataFrame) -> DataFrame:
    """Bytes of the removable columns of all blocks: hex digits are summed as
    whole numbers and halved once."""
    digits = None
    for c in REMOVABLE_BLOCK_COLUMNS:
        d = hex_digit_count(F.col(c))
        digits = d if digits is None else digits + d
    total = global_sum(blocks.select(digits.alias("digits")), "digits", "digits", label=OVERHEAD_LABEL)
    return total.select("label", (F.col("digits").cast("double") / F.lit(2.0)).alias("bytes"))


# --- scams (Q11, Q12) ---------------------------------------------------------------

def _scam_values(tx: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, total), the sums still in limbs."""
    members = _registry_rows(registry).select("address", "id")
    facts = _of_members(tx.select("to_address", _wei(tx, "value").alias("value")), "value", members)
    return join_then_aggregate(facts, members, "to_address", "address", "id", {"total": ("value", WHOLE)})


def scam_value_by_id(tx: DataFrame, registry: DataFrame, text: bool = False) -> DataFrame:
    return _scam_values(tx, registry).select("id", _shown("total", text).alias("total"))


def most_lucrative_scam(tx: DataFrame, registry: DataFrame, k: int = 1, text: bool = False) -> DataFrame:
    top = top_k(_scam_values(tx, registry), k, order_key("total"), "id")
    return top.select("id", _shown("total", text).alias("total"))


def _scam_facts(tx: DataFrame, registry: DataFrame) -> DataFrame:
    """(category, month, total in limbs): value per (address, month), once for
    every listing of the address under a category."""
    members = _registry_rows(registry).where(is_truthy_text(F.col("category"))).select("address", "category")
    facts = tx.select("to_address", _tx_month(tx).alias("month"), _wei(tx, "value").alias("value"))
    if "month" not in tx.columns:  # as with the value: every timestamp is parsed
        facts = facts.where(must(F.col("month").isNotNull(), F.lit("no month")))
    partial = _of_members(facts, "value", members).groupBy("to_address", "month").agg(exact_sum("value").alias("total"))
    return members_join(partial, members, "to_address", "address").select("category", "month", "total")


def scam_value_by_category_month(tx: DataFrame, registry: DataFrame, text: bool = False) -> DataFrame:
    agg = _scam_facts(tx, registry).groupBy("category", "month").agg(again("total").alias("total"))
    return agg.select("category", "month", _shown("total", text).alias("total"))


# --- presentation series (Q13, Q14) -------------------------------------------------

def chronological_series(series: DataFrame, label: str = "month", value: str = "n") -> DataFrame:
    """(ym, value) ordered by time, from an ``MM-yyyy`` keyed result."""
    return chronological(series, label, "ym").select("ym", value)


def series_head(series: DataFrame, n: int = 10, label: str = "month", value: str = "n") -> DataFrame:
    return first_n(chronological_series(series, label, value), n, "ym")


def series_tail(series: DataFrame, n: int = 5, label: str = "month", value: str = "n") -> DataFrame:
    return last_n(chronological_series(series, label, value), n, "ym")


def series_total(series: DataFrame, value: str = "n", name: str = "total") -> DataFrame:
    return global_sum(series, value, name)


def series_without(series: DataFrame, label: str = "label", excluded: str = EXCLUDED_SERIES_LABEL) -> DataFrame:
    return series.where(F.col(label) != F.lit(excluded))


def scam_series_pivot(tx: DataFrame, registry: DataFrame, text: bool = False) -> DataFrame:
    """One column per charted category (blanks removed), per ``yyyy-MM`` in
    time order: one aggregate straight over the joined sums."""
    s = _scam_facts(tx, registry).select(
        label_to_ym(F.col("month")).alias("ym"), squash_spaces(F.col("category")).alias("category"), "total"
    )
    charted = s.where(F.col("category").isin(*SERIES_CATEGORIES))
    of = {c: f"CASE WHEN category = '{c}' THEN total END" for c in SERIES_CATEGORIES}
    sums = charted.groupBy("ym").agg(*[again(sql).alias(c) for c, sql in of.items()], *[F.count(F.expr(sql)).alias(f"n_{c}") for c, sql in of.items()])
    shown = [F.when(F.col(f"n_{c}") > 0, _shown(c, text)).alias(c) for c in SERIES_CATEGORIES]
    return sums.select("ym", *shown).orderBy("ym")


def scam_series_head(tx: DataFrame, registry: DataFrame, category: str, n: int = 5, text: bool = False) -> DataFrame:
    """The first ``n`` months of one charted category."""
    of = scam_value_by_category_month(tx, registry, text).where(squash_spaces(F.col("category")) == category)
    return series_head(of, n, value="total")
