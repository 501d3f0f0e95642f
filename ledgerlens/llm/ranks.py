"""Places of rows within groups of any size, without gathering a group.

A window over a group would bring all its rows to one task. Here rows are dealt
to tasks by ranges of (key, order), so a hot group is spread over many of them;
each task numbers its rows, and what other tasks hold of the same group before
it is a running sum over one row per (task, key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, stored

#: Rows that one task orders; the number of tasks follows from the rows there are.
ROWS_PER_TASK = 1 << 20


def tasks_for(spark: SparkSession, rows: int, per_task: int = ROWS_PER_TASK) -> int:
    return max(partitions(spark), -(-rows // per_task))


def spread(rows: DataFrame, count: int, key: str, order: list[str | Column], name: str) -> tuple[DataFrame, DataFrame]:
    """(placed, spans) of ``rows``, a stored table of ``count`` rows with a
    ``key`` that is never null: the rows in the order of (key, order), stored, and (task, key, first,
    before, n) for each key that a task holds. Nulls in ``order`` come first;
    rows equal in all of it may stand in either order."""
    dealt = rows.repartitionByRange(tasks_for(rows.sparkSession, count), key, *order).sortWithinPartitions(key, *order)
    placed = stored(dealt.withColumn("__at", F.monotonically_increasing_id()), name)
    held = placed.groupBy(F.shiftright("__at", 33).alias("__task"), key).agg(F.min("__at").alias("__first"), F.count("*").alias("__here"))
    of_key = Window.partitionBy(key)
    earlier = of_key.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # at most one row per task
    spans = held.withColumn("__before", F.coalesce(F.sum("__here").over(earlier), F.lit(0))).withColumn("n", F.sum("__here").over(of_key))
    return placed, stored(spans.drop("__here"), f"{name}-spans")


def places(placed: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """``placed`` with ``pos`` (from 0 within its key) and the columns of
    ``spans`` (``n``: rows of the key). A key's rows of one task meet one row."""
    tasked = placed.withColumn("__task", F.shiftright("__at", 33))
    joined = tasked.join(spans, ["__task", key]).withColumn("pos", F.col("__at") - F.col("__first") + F.col("__before"))
    return joined.drop("__at", "__task", "__first", "__before")
