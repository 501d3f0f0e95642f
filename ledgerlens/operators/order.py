"""Top-k, chronological ordering and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import label_to_date, label_to_ym


def top_k(df: DataFrame, k: int, by: Column | str, tiebreak: str | Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties broken by ``tiebreak`` asc.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps
    a k-row heap and only k rows per task reach the final merge.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    order = F.col(by) if isinstance(by, str) else by
    return df.orderBy(order.desc(), *[F.col(t).asc() for t in ties]).limit(k)


def chronological(df: DataFrame, label: str = "month", ym: str = "ym") -> DataFrame:
    """Add a sortable ``yyyy-MM`` key for an ``MM-yyyy`` label and order by time.

    ``MM-yyyy`` labels do not sort in time; the date does.
    """
    return df.withColumn(ym, label_to_ym(F.col(label))).orderBy(label_to_date(F.col(label)))


def first_n(df: DataFrame, n: int, order: Column | str) -> DataFrame:
    o = F.col(order) if isinstance(order, str) else order
    return df.orderBy(o.asc()).limit(n)


def last_n(df: DataFrame, n: int, order: Column | str) -> DataFrame:
    """The ``n`` rows with the largest ``order``, in ascending order."""
    o = F.col(order) if isinstance(order, str) else order
    return df.orderBy(o.desc()).limit(n).orderBy(o.asc())


def pivot_series(
    df: DataFrame, row_key: str, pivot_col: str, values: Sequence[str], value: str
) -> DataFrame:
    """One column per listed category, summed per row key, in key order.

    One aggregate over conditional sums: the value list is explicit, so there
    is no extra job to find the categories and no second regrouping.
    """
    sums = [F.sum(F.when(F.col(pivot_col) == v, F.col(value))).alias(v) for v in values]
    return df.groupBy(row_key).agg(*sums).orderBy(row_key)
