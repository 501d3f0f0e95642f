"""Grouped and global aggregates.

Every aggregate here is distributive (count, sum), so Spark plans a partial
HashAggregate before the exchange: a hot key that holds a third of the rows is
combined map-side and only one row per key and task crosses the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sum_by(df: DataFrame, keys, value: Column | str, name: str = "total") -> DataFrame:
    """Sum of ``value`` per key (type kept: decimal stays exact, ANSI overflow raises)."""
    return df.groupBy(*_keys(keys)).agg(F.sum(value).alias(name))


def count_sum_by(
    df: DataFrame, keys, value: Column | str, n: str = "n", total: str = "total"
) -> DataFrame:
    """Count and sum in one pass: one scan, one exchange.

    Replaces the two-aggregates-then-join shape (count per key joined with
    sum per key over the same rows).
    """
    return df.groupBy(*_keys(keys)).agg(
        F.count(F.lit(1)).alias(n), F.sum(value).alias(total)
    )


def ratio(total: Column | str, n: Column | str) -> Column:
    """Exact sum over count, rounded once: cast(sum as double) / n."""
    t = F.col(total) if isinstance(total, str) else total
    c = F.col(n) if isinstance(n, str) else n
    return t.cast("double") / c.cast("double")


def global_sum(df: DataFrame, value: Column | str, name: str = "total", label: str | None = None,
               label_name: str = "label") -> DataFrame:
    """Sum over all rows; no row at all when the input is empty."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias(name)).where(F.col("_n") > 0)
    cols = ([F.lit(label).alias(label_name)] if label is not None else []) + [F.col(name)]
    return agg.select(*cols)

