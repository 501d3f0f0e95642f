"""Result sinks: distributed writes, never a driver-side collect.

A result is written as a dataset (JSON lines by default) under
``<base>/<run_id>/<name>``. The run folder replaces a wall-clock stamp in the
path; it must not contain ':' (not allowed in Hadoop paths). Staged data is
published atomically (:func:`publish`), so readers never see half a folder.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def render_exact(df: DataFrame) -> DataFrame:
    """Decimal columns -> plain integer text (26-digit sums do not fit a long)."""
    cols = [
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _fs(spark: SparkSession, path: str):
    """Hadoop file system and path object for ``path`` (None without a JVM gateway)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p
    except Exception:  # remote client session
        return None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system it names."""
    fs = _fs(spark, path)
    if fs is not None:
        return bool(fs[0].exists(fs[1]))
    try:
        spark.read.text(path)
        return True
    except Exception:
        return False


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what stands directly in a folder; none where there is no folder."""
    fs = _fs(spark, path)
    if fs is None:
        raise RuntimeError("folders are listed through the session's own JVM")
    fsys, root = fs
    return sorted(s.getPath().getName() for s in fsys.listStatus(root)) if fsys.exists(root) else []


def file_identity(spark: SparkSession, path: str) -> list[str]:
    """Name, length and modification time of every file below ``path``: what
    has to change when its content does."""
    fs = _fs(spark, path)
    if fs is None:
        return sorted(spark.read.format("binaryFile").load(path).select(F.concat_ws("|", "path", "length", "modificationTime")).toPandas().iloc[:, 0])
    fsys, root = fs
    if not fsys.exists(root):
        return []
    found, todo = [], [fsys.getFileStatus(root)]
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += list(fsys.listStatus(status.getPath()))
        else:
            found.append(f"{status.getPath().getName()}|{status.getLen()}|{status.getModificationTime()}")
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own, if it is there."""
    fs = _fs(spark, path)
    if fs is not None and fs[0].exists(fs[1]):
        fs[0].delete(fs[1], True)


def _writer(df: DataFrame, fmt: str, partition_by: tuple[str, ...], options: dict | None):
    writer = df.write.format(fmt).options(**(options or {}))
    return writer.partitionBy(*partition_by) if partition_by else writer


def publish(spark: SparkSession, df: DataFrame, path: str, fmt: str, existing: str = "error", partition_by: tuple[str, ...] = (), options: dict | None = None) -> None:
    """Write ``df`` to ``path`` so that readers only ever see a complete folder.

    The data goes to a private temporary folder next to the target, which is
    then renamed into place (atomic on HDFS and local disks). ``existing``
    says what happens to a complete folder that is already there: ``"error"``
    stops before anything is written, ``"overwrite"`` replaces it, and
    ``"keep"`` leaves it, which is only right where the path names its content
    (staging keyed by its input files). A folder without ``_SUCCESS`` is a
    failed attempt and is always replaced. ``partition_by`` names columns that
    become folders, ``options`` go to the writer. Replacing leaves a short gap between the old folder and the
    new one; :mod:`ledgerlens.versioned` leaves none.
    """
    if existing not in ("error", "overwrite", "keep"):
        raise ValueError(f"existing={existing!r}")
    fs = _fs(spark, path)
    if fs is None:
        _writer(df, fmt, partition_by, options).mode("overwrite" if existing == "overwrite" else "errorifexists").save(path)
        return
    fsys, target = fs
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = Path(target, "_SUCCESS")
    if fsys.exists(done) and existing != "overwrite":
        if existing == "error":
            raise FileExistsError(f"{path} exists; say that it shall be replaced, or name another folder")
        return
    src = Path(f"{path}.tmp-{uuid.uuid4().hex}")
    try:
        _writer(df, fmt, partition_by, options).mode("overwrite").save(src.toString())
        fsys.mkdirs(target.getParent())
        if fsys.exists(target) and (existing == "overwrite" or not fsys.exists(done)):
            fsys.delete(target, True)
        # Renaming onto a folder that another job has just published would move
        # ours into it: that copy is taken out again below.
        renamed = not fsys.exists(target) and fsys.rename(src, target)
        nested = Path(target, src.getName())
        if fsys.exists(nested):
            fsys.delete(nested, True)
            renamed = False
        if not renamed and existing != "keep":
            raise RuntimeError(f"another job published {path} at the same time")
        if not fsys.exists(done):
            raise RuntimeError(f"could not publish staged folder {path}")
    finally:
        if fsys.exists(src):
            fsys.delete(src, True)


def run_folder(now: datetime | None = None, prefix: str = "run") -> str:
    """A run id from the clock, safe in any Hadoop path: ``run_02-12-2026_11-05-09``."""
    now = now or datetime.now(timezone.utc)
    return f"{prefix}_{now.strftime('%d-%m-%Y_%H-%M-%S')}"


def result_path(base: str, name: str, run_id: str | None = None) -> str:
    if run_id is not None and ":" in run_id:
        raise ValueError(f"run id {run_id!r} contains ':', which Hadoop paths reject")
    parts = [base.rstrip("/")] + ([run_id] if run_id else []) + [name]
    return "/".join(parts)


def write_result(
    df: DataFrame,
    base: str,
    name: str,
    run_id: str | None = None,
    fmt: str = "json",
    mode: str = "overwrite",
    exact_text: bool = True,
) -> str:
    """Write one analysis result; returns the path written.

    ``exact_text`` renders wei decimals as integer text, so JSON readers in
    any language keep all digits.
    """
    path = result_path(base, name, run_id)
    out = render_exact(df) if exact_text else df
    out.write.mode(mode).format(fmt).save(path)
    return path


def stage_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """Write a (typed) frame as Parquet, optionally partitioned, e.g. validated
    transactions by month, so later analyses prune columns and partitions."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
