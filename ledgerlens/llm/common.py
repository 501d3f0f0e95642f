"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir

#: bytes -> bytes with A-Z lower-cased, everything else unchanged.
LOWER = bytes(range(256)).lower()
#: As LOWER; every ASCII byte that is not a letter or digit becomes a blank.
WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in LOWER)


_SHIPPED: set[str] = set()
#: Arrow batches of rows with whole texts: a task holds a few of them at once.
ARROW_BATCH, DEFAULT_BATCH = "2m", "67108864b"
#: Bytes of a batch on its way back: the JVM keeps memory outside its heap for the largest ones.
RETURNED_BYTES = 1 << 19


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that the
    functions given to Spark can be loaded there from any working directory.
    Where the session leaves the size of Arrow batches at its default, it is
    lowered, so that executors with little memory beside the heap suffice."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size, None) == DEFAULT_BATCH:
        spark.conf.set(size, ARROW_BATCH)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):  # else the package itself runs from a shipped archive
        target = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-"), "ledgerlens.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        archive.write(file, os.path.join("ledgerlens", os.path.relpath(file, root)))
        context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def _release() -> None:
    """Give back what a task has freed: Python workers live on and are reused."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        return


def returned(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``RETURNED_BYTES`` (at least one row each)."""
    rows = max(1, batch.num_rows * RETURNED_BYTES // max(1, batch.nbytes))
    if rows >= batch.num_rows:
        yield batch
        return
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in run(batches):
                yield from returned(batch)
        finally:
            _release()

    return df.mapInArrow(task, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is on this machine (the same on all)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_of(column: str = "text") -> Column:
    """The text as bytes; null counts as empty. Arrow hands it over uncopied."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:16]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut,
    it is computed once, and what a task wrote outlives its executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without copying: (all bytes, row offsets)."""
    if pa.types.is_large_binary(column.type):
        offsets = np.frombuffer(column.buffers()[1], np.int64)
    else:
        offsets = np.frombuffer(column.buffers()[1], np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
    return flat, offsets - (offsets[0] if len(offsets) else 0)


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of ``column``
    (at least one row each), so that temporary arrays stay small."""
    _, offsets = binary_view(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(n, max(stop, start + 1))
        yield batch.slice(start, stop - start)
        start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RANDOM = np.random.Generator(np.random.PCG64(20240607))
#: A random odd 64-bit value per byte value, and the base of the rolling sums.
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept while of ordinary size."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 19), np.uint64(base), np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 1 << 23:
            _POWERS[base] = have
    return have[:n]


def rolling_sums(flat: np.ndarray) -> np.ndarray:
    """Sums of value(byte) * base**place over the bytes before each place."""
    sums = np.empty(len(flat) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[flat] * powers(len(flat)), out=sums[1:])
    return sums


def span_hashes(flat: np.ndarray, starts: np.ndarray, stops: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte strings ``flat[starts:stops]``: the sum of
    value(byte) * base**place, made independent of where it stands, mixed."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = rolling_sums(flat) if sums is None else sums
    hashes = (sums[stops] - sums[starts]) * powers(len(flat), _BASE_INVERSE)[starts]
    return mix64(hashes + (stops - starts).astype(np.uint64))


#: Two primes below 2^31, with a base and a value per byte for each.
_PRIMES = (2147483647, 2147483629)
_PRIME_BASES = [int(b) for b in _RANDOM.integers(1 << 20, 1 << 30, 2)]
_PRIME_VALUES = [_RANDOM.integers(1, p, 256, dtype=np.uint64) for p in _PRIMES]


def _prime_powers(n: int, base: int, prime: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo a prime, by doubling."""
    out = np.ones(max(1, n), np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, prime)) % np.uint64(prime)
        have += more
    return out


def prime_hashes(flat: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the disjoint, ordered and non-empty byte strings
    ``flat[starts:stops]``: polynomials modulo two primes, 62 bits, mixed. Sums
    modulo 2^64 are alike for some regular texts, whatever their base (the
    Thue-Morse word and its complement); modulo a prime none is so built."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = stops - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    letters = flat[place + np.repeat(starts, lengths)]
    out = np.zeros(len(starts), np.uint64)
    for prime, base, values in zip(_PRIMES, _PRIME_BASES, _PRIME_VALUES, strict=True):
        terms = values[letters]
        terms *= _prime_powers(int(lengths.max()), base, prime)[place]
        terms %= np.uint64(prime)
        out = (out << np.uint64(32)) | (np.add.reduceat(terms, first) % np.uint64(prime))
    return mix64(mix64(out) + lengths.astype(np.uint64))


def word_hashes(flat: np.ndarray, offsets: np.ndarray, blank: np.ndarray, places: bool = False, hashes=span_hashes) -> tuple:
    """64-bit hashes of the words of all rows, in order, and each row's first
    word index (length rows + 1); with ``places`` also where words start and
    stop. ``blank[b]``: byte ``b`` separates words. All in array operations.
    """
    n = len(flat)
    if not n:
        none = np.empty(0, np.int64)
        out = np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
        return (*out, none, none) if places else out
    inside = ~blank[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = offsets[1:-1]
    rows = rows[rows < n]
    first[rows] = inside[rows]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = rows - 1
    ends = ends[ends >= 0]
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    stops = np.flatnonzero(last) + 1
    out = hashes(flat, starts, stops), np.searchsorted(starts, offsets).astype(np.int64)
    return (*out, starts, stops) if places else out


def blank_table(table_: bytes | None = None) -> np.ndarray:
    """Which bytes separate words: by default blank, tab to carriage return."""
    out = np.zeros(256, bool)
    if table_ is None:
        out[[9, 10, 11, 12, 13, 32]] = True
    else:
        out[[i for i in range(256) if table_[i] == 32]] = True
    return out


def lowered(flat: np.ndarray) -> np.ndarray:
    return np.frombuffer(LOWER, np.uint8)[flat]
