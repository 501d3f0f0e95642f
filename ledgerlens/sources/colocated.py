"""Address sums and long member lists stored where they meet.

A list that is too long to broadcast meets the transactions' sums by address,
in every analysis anew. Stored in buckets of the address, as many on both
sides, the two are joined, and the sums summed again, without an exchange:
what is shuffled is shuffled once, when it is stored.

What is stored has few rows per address, however hot it is: transactions as
sums per (address, month), combined in the map tasks first, and a list as one
row per address with its number of listings. Each bucket is one file, sorted.

A store is a versioned folder (:mod:`ledgerlens.versioned`), whose pointer also
says the key and the number of buckets, so that no reader can take them for
others. Spark learns about buckets from a catalog only: opening a store makes
an external table over its folder in the session's current database. Empty
input gives an empty store; null addresses are stored and meet nothing.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.sinks import file_identity
from ledgerlens.sources.summary import summarize
from ledgerlens.versioned import current, point

PARTITIONS = "spark.sql.shuffle.partitions"
SUMS_KEY, LIST_KEY = "to_address", "address"
#: Typed Parquet that one bucket is made for: one task sums, sorts and later
#: reads a bucket. Spark's own limit is 100,000 buckets.
BUCKET_BYTES, MAX_BUCKETS = 16 << 20, 100_000


def bucket_count(spark: SparkSession, typed: str, least: int) -> int:
    """Buckets for the typed transactions stored in a folder: ``least`` of
    them, and more where these would be large."""
    length = sum(int(f.rsplit("|", 2)[1]) for f in file_identity(spark, typed))
    return max(least, min(MAX_BUCKETS, math.ceil(length / BUCKET_BYTES)))


def _table(data: str) -> str:
    return f"ledgerlens_colocated_{data}"


def _store(df: DataFrame, root: str, key: str, buckets: int) -> int:
    spark, root, name = df.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    # Shuffled by the same hash as buckets are: one task writes one bucket.
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    own = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(max(int(own), buckets)))  # the sums are dealt as finely as their buckets
    try:
        writer.option("path", f"{root}/data/{name}").saveAsTable(_table(name))
    finally:
        spark.conf.set(PARTITIONS, own)
    spark.sql(f"DROP TABLE {_table(name)}")  # external: its files stay
    said = {"data": name, "format": "parquet", "schema": df.schema.jsonValue(), "key": key, "buckets": buckets}
    return point(spark, root, said)


def _open(spark: SparkSession, root: str, key: str) -> DataFrame:
    said = current(spark, root)
    if said.get("key") != key:
        raise ValueError(f"{root} is not stored by {key}")
    if not spark.catalog.tableExists(_table(said["data"])):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(said["schema"]))
        where = f"{root.rstrip('/')}/data/{said['data']}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_table(said['data'])} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
                  f"SORTED BY (`{key}`) INTO {int(said['buckets'])} BUCKETS LOCATION '{where}'")
    return spark.table(_table(said["data"]))


def store_sums(typed: DataFrame, root: str, buckets: int) -> int:
    """Typed transactions (``sources.typed``) as sums per (address, month)."""
    return _store(summarize(typed, (SUMS_KEY, "month")), root, SUMS_KEY, buckets)


def store_list(members: DataFrame, root: str, buckets: int) -> int:
    """A member list's addresses with how often each of them is listed."""
    listed = members.groupBy(LIST_KEY).agg(F.count(F.lit(1)).alias("listings"))
    return _store(listed, root, LIST_KEY, buckets)


def open_sums(spark: SparkSession, root: str) -> DataFrame:
    """The stored sums: a summary for :mod:`ledgerlens.plans.incremental`."""
    return _open(spark, root, SUMS_KEY)


def open_list(spark: SparkSession, root: str) -> DataFrame:
    """(address), once for each of its listings."""
    listed = _open(spark, root, LIST_KEY)
    return listed.select(LIST_KEY, F.explode(F.sequence(F.lit(1), F.col("listings").cast("int"))).alias("n")).select(LIST_KEY)
