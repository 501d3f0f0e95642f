"""Results that are replaced without a gap, on any store.

A folder cannot be replaced in one step where a rename is a copy. Here nothing
is replaced: each version is a folder of its own, and a small pointer object,
written last and never touched again, names it. Layout below ``root``::

    data/<id>/           the rows of one version, as Spark writes them
    pointers/<ordinal>   JSON: the folder, its format and its schema

The current version is the one of the highest pointer. A pointer counts when
its text is whole, so readers always see one complete version: the old one
until the pointer stands, the new one from then on, and the old one still if
the writer dies before that. A reader that has begun keeps its version for as
long as :func:`prune` leaves it. Two writers at the same time: on file systems
that refuse to create an object twice the second takes the next ordinal; on
stores that do not, the one that ends last is the current version.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlens.sinks import _fs, children, remove


def _pointers(spark: SparkSession, root: str) -> list[int]:
    return sorted((int(n) for n in children(spark, f"{root}/pointers") if n.isdigit()), reverse=True)


def _pointer_path(root: str, ordinal: int) -> str:
    return f"{root}/pointers/{ordinal:010d}"


def _pointer(spark: SparkSession, root: str, ordinal: int) -> dict | None:
    """What a pointer says; None if it is being written, was cut short (some
    file systems check sums and refuse it then) or has been pruned."""
    fsys, path = _fs(spark, _pointer_path(root, ordinal))
    try:
        stream = fsys.open(path)
        try:
            said = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() not in ("FileNotFoundException", "ChecksumException"):
            raise
        return None
    try:
        return json.loads(said)
    except ValueError:
        return None


def point(spark: SparkSession, root: str, said: dict) -> int:
    """Write the next pointer; the object appears whole or not at all on
    stores, and is whole once its last brace stands on file systems."""
    refused = None
    for _ in range(20):
        ordinal = max(_pointers(spark, root), default=-1) + 1
        fsys, path = _fs(spark, _pointer_path(root, ordinal))
        try:
            stream = fsys.create(path, False)
        except Exception as e:  # another writer has just taken the ordinal
            if not fsys.exists(path):
                raise
            refused = e
            continue
        try:
            stream.write(bytearray(json.dumps(said).encode()))
        finally:
            stream.close()
        return ordinal
    raise RuntimeError(f"other writers kept taking the next version of {root}") from refused


def publish_version(spark: SparkSession, df: DataFrame, root: str, fmt: str = "json") -> int:
    """Write ``df`` as the next version below ``root`` and make it the current
    one; returns its ordinal. The executors write the rows, the driver the
    pointer."""
    root = root.rstrip("/")
    if _fs(spark, root) is None:
        raise RuntimeError("pointers are written through the session's own JVM")
    name = uuid.uuid4().hex
    df.write.format(fmt).save(f"{root}/data/{name}")
    return point(spark, root, {"data": name, "format": fmt, "schema": df.schema.jsonValue()})


def versions(spark: SparkSession, root: str) -> list[int]:
    """Ordinals of the versions that can be read, newest first."""
    root = root.rstrip("/")
    return [v for v in _pointers(spark, root) if _pointer(spark, root, v) is not None]


def current(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """What the pointer of the current (or the given) version says."""
    root = root.rstrip("/")
    for ordinal in _pointers(spark, root) if version is None else [version]:
        said = _pointer(spark, root, ordinal)
        if said is not None:
            return said
    raise FileNotFoundError(f"no version of {root}")


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of the current version, or of an earlier one that is kept; with
    the schema they were written with, so an empty result reads back too."""
    root = root.rstrip("/")
    said = current(spark, root, version)
    schema = StructType.fromJson(said["schema"])
    return spark.read.format(said["format"]).schema(schema).load(f"{root}/data/{said['data']}")


def prune(spark: SparkSession, root: str, keep: int = 3) -> int:
    """Remove all but the ``keep`` newest versions, pointers before rows;
    returns how many. Rows that no pointer ever named stay: their writer may
    still be at work."""
    if keep < 1:
        raise ValueError("the current version is always kept")
    root, gone = root.rstrip("/"), 0
    for ordinal in versions(spark, root)[keep:]:
        said = _pointer(spark, root, ordinal)
        remove(spark, _pointer_path(root, ordinal))
        remove(spark, f"{root}/data/{said['data']}")
        gone += 1
    return gone
