"""The monthly transaction analyses over a folder that keeps receiving dump files.

Same parser and same aggregate as the batch analysis; Structured Streaming
keeps the per-month count and exact sum as state and emits updated months.
Months are closed calendar intervals of a slowly advancing ledger, so the
state holds one row per month and stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.plans.analyses import monthly_value_stats
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sinks import publish, render_exact
from ledgerlens.sources.ledger import parse_transactions


def transaction_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Validated transactions from text files arriving under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_transactions(reader.load(path))


def monthly_stats_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (month, n, total, avg)."""
    return monthly_value_stats(transaction_stream(spark, path, max_files_per_trigger))


def start_monthly_stats(
    spark: SparkSession,
    path: str,
    query_name: str,
    checkpoint: str | None = None,
    sink: str = "memory",
    output_mode: str = "complete",
    available_now: bool = False,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start the monthly aggregate; state and progress live under ``checkpoint``
    (default: the session's shared checkpoint folder), so a restarted query
    resumes where it stopped."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"
    w = (
        monthly_stats_stream(spark, path)
        .writeStream.format(sink)
        .queryName(query_name)
        .outputMode(output_mode)
        .option("checkpointLocation", ckpt)
    )
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def start_monthly_stats_to_files(
    spark: SparkSession,
    path: str,
    output: str,
    query_name: str,
    checkpoint: str | None = None,
    available_now: bool = False,
    fmt: str = "json",
) -> StreamingQuery:
    """Like :func:`start_monthly_stats`, writing every epoch's complete result
    to ``<output>/epoch=<id>`` (published atomically, exact wei as text).

    A replayed epoch after a failure, or a new query on an old output folder,
    replaces the epoch's folder; readers take the highest epoch.
    """
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{query_name}"

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        publish(batch.sparkSession, render_exact(batch), f"{output.rstrip('/')}/epoch={epoch_id}", fmt, existing="overwrite")

    w = (
        monthly_stats_stream(spark, path)
        .writeStream.queryName(query_name)
        .outputMode("complete")
        .option("checkpointLocation", ckpt)
        .foreachBatch(write_epoch)
    )
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def latest_epoch(spark: SparkSession, output: str) -> str:
    """The folder of the highest epoch below ``output``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(output)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    epochs = [int(n.removeprefix("epoch=")) for n in names if n.startswith("epoch=") and n[6:].isdigit()]
    return f"{output.rstrip('/')}/epoch={max(epochs)}"
