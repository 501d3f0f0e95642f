"""The transaction analyses, answered from the summary (``sources.summary``).

Same results as :mod:`ledgerlens.plans.analyses` on the dumps themselves. Sums
of files are summed again, per month or per address; lists meet one row per
address (and month), as there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import fault_text, is_truthy_text, must
from ledgerlens.operators.aggregate import ratio
from ledgerlens.operators.exact import again, as_decimal, as_double, as_long, as_text, order_key
from ledgerlens.operators.join import members_join
from ledgerlens.operators.member_filter import may_be_listed
from ledgerlens.operators.order import top_k
from ledgerlens.plans.analyses import AVG_GAS_LABEL
from ledgerlens.sources.ledger import registry_addresses


def _shown(total: str, text: bool) -> F.Column:
    return as_text(total) if text else as_decimal(total)


def _sound(df: DataFrame, fault: str) -> DataFrame:
    return df.where(must(F.col(fault).isNull(), fault_text(F.col(fault))))


def _rows(registry: DataFrame) -> DataFrame:
    return registry if "address" in registry.columns else registry_addresses(registry)


def monthly_value_stats(summary: DataFrame, text: bool = False) -> DataFrame:
    """month, n, total (wei), avg (wei)."""
    agg = summary.groupBy("month").agg(F.sum("n").alias("n"), again("value").alias("total"))
    return agg.select("month", "n", _shown("total", text).alias("total"), ratio(as_double("total"), "n").alias("avg"))


def monthly_average_gas_price(summary: DataFrame) -> DataFrame:
    agg = summary.groupBy("month").agg(F.sum("n").alias("n"), again("gas_price").alias("total"))
    return agg.select("month", ratio(as_double("total"), "n").alias("avg"))


def _contract_values(summary: DataFrame, contracts: DataFrame) -> DataFrame:
    totals = summary.groupBy("to_address").agg(again("value").alias("total"))
    return members_join(totals, contracts.select("address"), "to_address", "address").withColumnRenamed("to_address", "address")


def top_contracts_by_value(summary: DataFrame, contracts: DataFrame, k: int = 10, text: bool = False) -> DataFrame:
    top = top_k(_contract_values(summary, contracts), k, order_key("total"), "address")
    return top.select("address", _shown("total", text).alias("total"))


def monthly_contract_gas(summary: DataFrame, contracts: DataFrame) -> DataFrame:
    """Gas of transactions to listed contracts; malformed gas counts only where
    the list has the address."""
    partial = summary.groupBy("to_address", "month").agg(again("gas_int").alias("gas"), F.min("bad_int").alias("bad"))
    joined = members_join(partial, contracts.select("address"), "to_address", "address")
    agg = joined.groupBy("month").agg(again("gas").alias("gas"), F.min("bad").alias("bad"))
    return _sound(agg, "bad").select("month", as_long("gas").alias("gas"))


def average_contract_gas(summary: DataFrame, contracts: DataFrame) -> DataFrame:
    """Average gas, each truncated to an integer; malformed gas counts wherever it is."""
    partial = summary.groupBy("to_address").agg(again("gas_whole").alias("gas"), F.sum("n").alias("n"), F.min("bad_gas").alias("bad"))
    joined = members_join(_sound(partial, "bad"), contracts.select("address"), "to_address", "address")
    agg = joined.agg(again("gas").alias("gas"), F.sum("n").alias("n")).where("n > 0")
    return agg.select(F.lit(AVG_GAS_LABEL).alias("label"), ratio(as_double("gas"), "n").alias("avg"))


def gas_of_top_contracts_by_value(summary: DataFrame, contracts: DataFrame, k: int = 10) -> DataFrame:
    """Gas of the ``k`` listings that received the most value."""
    sums = summary.groupBy("to_address").agg(again("value").alias("total"), again("gas", floats=True).alias("gas"), F.min("bad_gas").alias("bad"))
    joined = members_join(_sound(sums, "bad"), contracts.select("address"), "to_address", "address").withColumnRenamed("to_address", "address")
    top = top_k(joined.select("address", "total", "gas"), k, order_key("total"), "address")
    return top.groupBy("address").agg(again("gas", floats=True).alias("gas")).select("address", as_double("gas", floats=True).alias("gas"))


def _of_members(summary: DataFrame, members: DataFrame, *keys: str) -> DataFrame:
    """Value per address (and ``keys``) of those that a short list may hold, joined to it."""
    listed = summary.where(may_be_listed("to_address", members, "address"))
    return members_join(listed.groupBy("to_address", *keys).agg(again("value").alias("total")), members, "to_address", "address")


def most_lucrative_scam(summary: DataFrame, registry: DataFrame, k: int = 1, text: bool = False) -> DataFrame:
    joined = _of_members(summary, _rows(registry).select("address", "id"))
    top = top_k(joined.groupBy("id").agg(again("total").alias("total")), k, order_key("total"), "id")
    return top.select("id", _shown("total", text).alias("total"))


def scam_value_by_category_month(summary: DataFrame, registry: DataFrame, text: bool = False) -> DataFrame:
    members = _rows(registry).where(is_truthy_text(F.col("category"))).select("address", "category")
    agg = _of_members(summary, members, "month").groupBy("category", "month").agg(again("total").alias("total"))
    return agg.select("category", "month", _shown("total", text).alias("total"))
