"""Readers for stored result artifacts.

Legacy artifacts are a JSON array written on a single line
(``[[label, number], ...]``). They are bounded by the size of a result, so a
whole file per row is acceptable here; results written by this package are
JSON-lines datasets and are read with :func:`read_result`.

Numbers are read as *text* and cast by the caller: wei totals have up to 26+
digits and must not pass through a double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _pairs(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True)
    return raw.select(
        F.explode(F.from_json(F.col("value"), "array<array<string>>", {"mode": "FAILFAST"})).alias("p")
    )


def read_legacy_pairs(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """``[[k, v], ...]`` -> (key string, value string)."""
    return _pairs(spark, path).select(
        F.get(F.col("p"), 0).alias(key), F.get(F.col("p"), 1).alias(value)
    )


def read_legacy_nested_pairs(
    spark: SparkSession,
    path: str,
    keys: tuple[str, str] = ("category", "month"),
    value: str = "total",
) -> DataFrame:
    """``[[[k1, k2], v], ...]`` -> (k1, k2, value) strings.

    The inner key pair arrives as JSON text and is parsed a second time.
    """
    p = _pairs(spark, path)
    inner = F.from_json(F.get(F.col("p"), 0), "array<string>", {"mode": "FAILFAST"})
    return p.select(
        F.get(inner, 0).alias(keys[0]),
        F.get(inner, 1).alias(keys[1]),
        F.get(F.col("p"), 1).alias(value),
    )


def read_result(spark: SparkSession, path: str, fmt: str = "json", schema=None) -> DataFrame:
    """Read back a result written by :func:`ledgerlens.sinks.write_result`."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
