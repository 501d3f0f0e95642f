"""Counts and rejected lines of a dump, from the pass that reads it anyway.

:func:`observed` counts while an analysis runs: the figures are those of
:func:`ledgerlens.sources.ledger.validity_counts`, without a second scan. Spark
sums observed metrics as tasks end, so a map stage that runs again because an
executor was lost counts its lines again; use them to watch a job.

:func:`sort_out` writes every line once, kept ones as named columns and
rejected ones as they are with what is wrong with them. Its counts are counts
of written rows (read from file footers), exact whatever is lost on the way.

A line is rejected for its ``fields`` (their number is not the layout's) or,
with the right number, for its ``probe``. A null line has no fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sinks import publish
from ledgerlens.sources.ledger import CHECKS, well_formed

KEPT, FIELDS, PROBE = "kept", "fields", "probe"


def outcome(kind: str) -> Column:
    """``kept``, or what is wrong with the line; fields are only counted where
    the one regex pass has refused the line."""
    layout, probe_field = CHECKS[kind]
    count = F.size(F.split(F.col("value"), ",", -1))
    wrong = F.when(F.col("value").isNull() | (count != layout.arity), FIELDS).otherwise(PROBE)
    return F.when(well_formed(layout, probe_field), KEPT).otherwise(wrong)


def observed(lines: DataFrame, kind: str) -> tuple[DataFrame, Observation]:
    """The well-formed rows of ``lines``, and an observation that holds
    ``lines``, ``valid``, ``wrong_fields`` and ``wrong_probe`` once an action
    on the rows, or on what is made of them, has ended."""
    layout, _ = CHECKS[kind]
    counts = Observation(f"{kind} lines")
    of = lines.withColumn("outcome", outcome(kind)).observe(
        counts,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("outcome") == KEPT).alias("valid"),
        F.count_if(F.col("outcome") == FIELDS).alias("wrong_fields"),
        F.count_if(F.col("outcome") == PROBE).alias("wrong_probe"),
    )
    named = [f"get(split(value, ',', -1), {i}) AS `{c}`" for i, c in enumerate(layout.columns)]
    return of.where(F.col("outcome") == KEPT).selectExpr(*named), counts


def sort_out(spark: SparkSession, lines: DataFrame, kind: str, path: str, existing: str = "error") -> None:
    """Publish all of ``lines`` below ``path`` as Parquet, one folder for each
    outcome: the layout's columns as text for kept lines, ``line`` for others."""
    layout, _ = CHECKS[kind]
    kept = "outcome = 'kept'"
    named = [f"CASE WHEN {kept} THEN get(split(value, ',', -1), {i}) END AS `{c}`" for i, c in enumerate(layout.columns)]
    out = lines.withColumn("outcome", outcome(kind)).selectExpr(*named, f"CASE WHEN NOT {kept} THEN value END AS line", "outcome")
    publish(spark, out, path, "parquet", existing=existing, partition_by=("outcome",))


def _sorted(spark: SparkSession, path: str, kind: str) -> DataFrame:
    layout, _ = CHECKS[kind]
    columns = ", ".join(f"`{c}` string" for c in (*layout.columns, "line", "outcome"))
    return spark.read.schema(columns).parquet(path)


def kept_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The well-formed rows, as the text reader of ``kind`` gives them; each
    analysis reads only its columns."""
    layout, _ = CHECKS[kind]
    return _sorted(spark, path, kind).where(F.col("outcome") == KEPT).select(*layout.columns)


def rejected_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(line, reason) of every line that was not kept."""
    return _sorted(spark, path, kind).where(F.col("outcome") != KEPT).select("line", F.col("outcome").alias("reason"))


def outcome_counts(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One row: lines, valid, wrong_fields, wrong_probe. No column is read."""
    of = _sorted(spark, path, kind).select("outcome")
    return of.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("outcome") == KEPT).alias("valid"),
        F.count_if(F.col("outcome") == FIELDS).alias("wrong_fields"),
        F.count_if(F.col("outcome") == PROBE).alias("wrong_probe"),
    )
