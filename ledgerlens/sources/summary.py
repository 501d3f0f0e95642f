"""A transaction summary that grows file by file.

Every analysis of transactions is a sum over an address, a month, or both. The
summary keeps those sums per (dump file, address, month), exact and in limbs
(:mod:`ledgerlens.operators.exact`), so that they can be summed again, and
:mod:`ledgerlens.plans.incremental` answers from it without the dumps.

``refresh`` compares the dump folder with what the summary holds. A file is
known by its path, length and modification time: only new and changed files are
read, a changed one replaces its former sums, one that is gone loses them, and
feeding the same files again does nothing. Layout below ``root``::

    sums/commit=<id>/   Parquet: the sums of the files of one refresh
    log/<ordinal>/      Parquet: (ordinal, commit, file, length, modified, present)

The log entry is published last and under the next free ordinal: readers see a
refresh wholly or not at all, one that dies leaves sums that nothing names, and
of two at the same time the second one compares again.

Staging rules hold (:mod:`ledgerlens.sources.typed`): a malformed value, gas
price or time, and gas that no sum can hold (infinite, nan), stop the refresh;
malformed gas is carried as a code and stops only the analyses that meet it.
An empty file counts as none; a folder without files gives no sums.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.columns import fault_code
from ledgerlens.operators.exact import exact_float_sum, exact_sum, whole_part
from ledgerlens.sinks import children, path_exists, publish
from ledgerlens.sources.ledger import parse_transactions
from ledgerlens.sources.typed import typed_transactions

LOG = "ordinal long, commit string, file string, length long, modified timestamp, present boolean"


def summarize(typed: DataFrame, keys=("to_address", "month")) -> DataFrame:
    """Typed transactions -> their sums per ``keys``: one aggregate, combined
    in the map tasks, so a hot address is one row for each of them."""
    gas = F.coalesce("gas", F.lit(0.0))
    facts = typed.select(
        *keys, "value", "gas_price", "gas_int", gas.alias("gas"),
        fault_code(1, F.col("gas_int"), F.col("gas_text")).alias("bad_int"),
        fault_code(1, F.col("gas"), F.col("gas_text")).alias("bad_gas"),
    ).withColumn("gas_whole", whole_part("gas"))
    return facts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        exact_sum("value").alias("value"),
        exact_sum("gas_price").alias("gas_price"),
        exact_sum("gas_int").alias("gas_int"),
        F.min("bad_int").alias("bad_int"),
        exact_float_sum("gas").alias("gas"),
        exact_sum("gas_whole").alias("gas_whole"),
        F.min("bad_gas").alias("bad_gas"),
    )


def dump_files(spark: SparkSession, dumps: str) -> DataFrame:
    """(path, file, length, modified) of the files in a dump folder; no file is opened."""
    listed = spark.read.format("binaryFile").load(dumps)
    return listed.select("path", F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def held_files(spark: SparkSession, root: str) -> DataFrame:
    """The log: of each file, the entry of the latest refresh that names it."""
    entries = [name for name in children(spark, f"{root}/log") if name.isdigit()]  # others are being written
    if not entries:
        return spark.createDataFrame([], LOG)
    log = spark.read.schema(LOG).parquet(*(f"{root}/log/{name}" for name in entries))
    names = [c for c in log.columns if c != "file"]
    return log.groupBy("file").agg(F.max(F.struct(*names)).alias("e")).select("file", *(f"e.{c}" for c in names))


def _changes(spark: SparkSession, dumps: str, root: str) -> list:
    held = held_files(spark, root).where("present").select("file", F.col("length").alias("l"), F.col("modified").alias("m"))
    both = dump_files(spark, dumps).join(held, "file", "full_outer")
    return both.where("path IS NULL OR l IS NULL OR length <> l OR modified <> m").select("path", "file", "length", "modified").collect()


def refresh(spark: SparkSession, dumps: str, root: str, attempts: int = 5) -> int:
    """Bring the summary at ``root`` in line with the files of ``dumps``;
    returns how many files were read or dropped. What the driver sees of them
    is the names of those that changed."""
    root = root.rstrip("/")
    for attempt in range(attempts):
        ordinal = 1 + max((int(name) for name in children(spark, f"{root}/log") if name.isdigit()), default=-1)
        changed = _changes(spark, dumps, root)
        if not changed:
            return 0
        commit = uuid.uuid4().hex
        read = [r.path for r in changed if r.path is not None]
        if read:
            lines = spark.read.text(read).select("value", F.col("_metadata.file_path").alias("file"))
            typed = typed_transactions(parse_transactions(lines, carry=("file",)), carry=("file",))
            summarize(typed, ("file", "to_address", "month")).write.parquet(f"{root}/sums/commit={commit}")
        entries = [(ordinal, commit, r.file, r.length, r.modified, r.path is not None) for r in changed]
        try:
            publish(spark, spark.createDataFrame(entries, LOG), f"{root}/log/{ordinal:010d}", "parquet", existing="error")
            return len(changed)
        except (FileExistsError, RuntimeError):  # another refresh took the ordinal
            if attempt + 1 == attempts:
                raise
    raise AssertionError("unreachable")


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    """Sums of the files that the summary holds: several rows per (address,
    month), one for each file with such transactions."""
    root = root.rstrip("/")
    held = held_files(spark, root).where("present")
    commits = [r[0] for r in held.select("commit").distinct().collect()]  # refreshes, not files
    paths = [p for p in (f"{root}/sums/commit={c}" for c in sorted(commits)) if path_exists(spark, p)]
    if not paths:
        empty = spark.createDataFrame([], "to_address string, month string, value decimal(38,0), gas_price decimal(38,0), gas_int decimal(38,0), gas double, gas_text string")
        return summarize(empty)
    sums = spark.read.option("basePath", f"{root}/sums").parquet(*paths)
    # Sums of a file's former content stay behind in an older commit.
    return sums.join(held.select("commit", "file"), ["commit", "file"], "left_semi").drop("commit", "file")
