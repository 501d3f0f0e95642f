"""Session builder and storage configuration.

Everything here is plain Spark configuration. The analyses themselves never
read the environment: object-store credentials are passed in by the caller.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every analysis relies on.
#  * UTC: month labels are computed in UTC whatever the host zone.
#  * ANSI: casts fail loud instead of turning bad numbers into nulls.
#  * AQE: runtime coalescing, skew-join splitting and broadcast conversion
#    from measured (not estimated) shuffle sizes.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting points for a large cluster (100 TB of text, ~1000 executors).
#  * Text splits of 256 MB keep tasks at a few seconds each and the task count
#    near 400k for 100 TB; parsing is linear, so splits never need to fit in
#    memory as a whole.
#  * Shuffles start wide (AQE coalesces small partitions to ~128 MB and splits
#    skewed ones), which keeps every reducer's share bounded when one key holds
#    a third of the rows before partial aggregation.
#  * Broadcasts chosen by AQE stay below 64 MB measured size.
#  * Speculation re-runs stragglers; lost executors are recomputed from lineage.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.speculation": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "ledgerlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Create (or reuse) a session with the settings the analyses expect;
    ``cluster=True`` adds the large-cluster sizing above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**CORE_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only when it is unset (local tests) a scratch folder is created
    and registered with the context (the setting itself is a core conf that
    cannot be changed on a running session).
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    try:
        sc = spark.sparkContext
    except Exception:  # remote client session: no context to register with
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    master = spark.conf.get("spark.master", "") or ""
    if not master.startswith("local"):
        # A machine-local folder is invisible to other executors (and lost
        # with its machine): on a cluster the shared folder must be named.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for this cluster")
    local = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is None:
        return local
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = False,
) -> dict[str, str]:
    """Hadoop s3a settings for an S3-compatible store, as session config.

    Pass the result as ``extra`` to :func:`build_session`; any ``s3a://``,
    ``hdfs://`` or ``file:`` path can then be read by the sources.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
