"""Readers for the raw ledger dumps (text -> named, validated columns).

A raw row is a plain text line split on ',' (not quote-aware: a quoted comma
changes the field count and the row is dropped, as in the dumps' original
consumers). A row is kept when it has exactly the layout's arity and its probe
field passes. Kept rows are handed on as *strings*; each analysis casts only
the columns it uses, strictly, so Catalyst prunes the rest and a malformed
unused column never breaks an unrelated analysis.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.columns import must
from ledgerlens.schemas import (
    BLOCKS,
    CONTRACTS,
    POPULAR_CONTRACTS,
    SCAM_DOCUMENT,
    TRANSACTIONS,
    Layout,
)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw text lines of one or more files/folders (``value`` column).

    Splittable: a large CSV dump is read by many tasks in parallel.
    """
    return spark.read.text(path)


def _fields(lines: DataFrame) -> DataFrame:
    return lines.select(F.split(F.col("value"), ",", -1).alias("f"))


# Probe patterns (Python ``int()`` text; the exact flag words).
INT_FIELD = r"\s*[+-]?[0-9]+(?:_[0-9]+)*\s*"
FLAG_FIELD = r"True|False"


def line_pattern(layout: Layout, probe_field: str) -> str:
    """Regex matching a whole line with exactly ``layout.arity`` comma-separated
    fields whose probe field matches ``probe_field``.

    One linear pass over the raw line, without splitting it: the filter does
    not allocate, and the line is split once, only for rows that are kept.
    """
    before = layout.index(layout.probe)
    after = layout.arity - before - 1
    # Written out field by field: measurably faster than a repeated group.
    return "^" + "[^,]*," * before + f"(?:{probe_field})" + ",[^,]*" * after + "\\z"


def well_formed(layout: Layout, probe_field: str) -> Column:
    """Whether the line in ``value`` is kept (never null)."""
    return F.coalesce(F.col("value").rlike(line_pattern(layout, probe_field)), F.lit(False))


def _parse(lines: DataFrame, layout: Layout, probe_field: str, carry=()) -> DataFrame:
    # One projection: codegen's subexpression elimination splits each kept
    # line once for all named fields.
    named = [f"get(split(value, ',', -1), {i}) AS `{c}`" for i, c in enumerate(layout.columns)]
    return lines.where(well_formed(layout, probe_field)).selectExpr(*named, *carry)


def parse_transactions(lines: DataFrame, carry=()) -> DataFrame:
    """Well-formed transaction rows: 15 fields and an integer block number;
    ``carry`` names columns of ``lines`` that come along."""
    return _parse(lines, TRANSACTIONS, INT_FIELD, carry)


def parse_contracts(lines: DataFrame) -> DataFrame:
    """Well-formed contract rows: 6 fields and ``is_erc20`` exactly True/False.

    Rows are not de-duplicated: a contract listed twice counts twice.
    """
    return _parse(lines, CONTRACTS, FLAG_FIELD)


def parse_blocks(lines: DataFrame) -> DataFrame:
    """Well-formed block rows: 19 fields and an integer block number."""
    return _parse(lines, BLOCKS, INT_FIELD)


CHECKS = {
    "transactions": (TRANSACTIONS, INT_FIELD),
    "contracts": (CONTRACTS, FLAG_FIELD),
    "blocks": (BLOCKS, INT_FIELD),
}


def validity_counts(lines: DataFrame, kind: str) -> DataFrame:
    """One row: lines read, lines kept by the well-formedness check, dropped."""
    layout, probe_field = CHECKS[kind]
    flagged = lines.select(well_formed(layout, probe_field).cast("int").alias("ok"))
    agg = flagged.agg(F.count(F.lit(1)).alias("lines"), F.sum("ok").cast("bigint").alias("valid"))
    return agg.select("lines", "valid", (F.col("lines") - F.col("valid")).alias("dropped"))


def read_transactions(spark: SparkSession, path) -> DataFrame:
    return parse_transactions(read_lines(spark, path))


def read_contracts(spark: SparkSession, path) -> DataFrame:
    return parse_contracts(read_lines(spark, path))


def read_blocks(spark: SparkSession, path) -> DataFrame:
    return parse_blocks(read_lines(spark, path))


def parse_registry(lines: DataFrame) -> DataFrame:
    """Scam registry documents -> one row per registry entry.

    Each line is a JSON object whose ``result`` maps an entry name to the
    entry. Malformed JSON fails the job (FAILFAST); so do a document without
    ``result`` and an entry without a numeric id or without a category, as
    missing keys would. Of entries with one name in a document the last one
    counts, as in any JSON object. Null ``addresses`` are an empty list.
    Columns: name, id, category, status, addresses.
    """
    doc = F.from_json(F.col("value"), SCAM_DOCUMENT, {"mode": "FAILFAST"})
    docs = lines.where(F.length(F.trim(F.col("value"))) > 0).select(
        F.monotonically_increasing_id().alias("_doc"), doc.getField("result").alias("result")
    )
    docs = docs.where(must(F.col("result").isNotNull(), F.lit("registry document without result")))
    listed = docs.select("_doc", F.posexplode(F.map_entries("result")).alias("_place", "_pair"))
    last = listed.groupBy("_doc", F.col("_pair.key").alias("name")).agg(
        F.max_by(F.col("_pair.value"), F.col("_place")).alias("entry")
    )
    return checked_entries(last)


def checked_entries(last: DataFrame) -> DataFrame:
    """(name, entry) -> the entries' columns; one without id or category stops the job."""
    e = F.col("entry")
    checked = last.where(
        must(e.getField("id").isNotNull(), F.concat(F.lit("registry entry without numeric id: "), F.col("name")))
        & must(e.getField("category").isNotNull(), F.concat(F.lit("registry entry without category: "), F.col("name")))
    )
    return checked.select(
        F.col("name"),
        e.getField("id").alias("id"),
        e.getField("category").alias("category"),
        e.getField("status").alias("status"),
        e.getField("addresses").alias("addresses"),
    )


def registry_addresses(registry: DataFrame) -> DataFrame:
    """One row per (address, entry). An address listed by several entries
    credits each of them; entries without addresses disappear."""
    return registry.select(
        F.explode(F.col("addresses")).alias("address"),
        "id",
        "category",
        "status",
    )


def read_registry(spark: SparkSession, path) -> DataFrame:
    return parse_registry(read_lines(spark, path))


def parse_popular_contracts(lines: DataFrame) -> DataFrame:
    """Headerless ``address,total`` lines (total may be in e-notation and is
    kept as text; no analysis uses it)."""
    f = _fields(lines)
    checked = f.select(
        F.when(F.size("f") >= 2, F.get(F.col("f"), 0))
        .otherwise(F.raise_error(F.lit("popular-contract line with fewer than 2 fields")))
        .alias("address"),
        F.get(F.col("f"), 1).alias("total"),
    )
    return checked.select(*[F.col(c.name) for c in POPULAR_CONTRACTS.fields])


def read_popular_contracts(spark: SparkSession, path) -> DataFrame:
    return parse_popular_contracts(read_lines(spark, path))
