"""Exact deduplication over an extendible-hash index on shared files.

The index key is a 64-bit hash of the text; its leading bits address a
directory. The directory starts with one bucket and doubles while a bucket
holds more than ``capacity`` bytes of different texts, splitting only that
bucket (a bucket of one key is never split). Map tasks fold the copies they
see into one entry (text, rows, largest id) and send entries to the owner task
of their bucket. An owner reads its key range in key order and keeps a chain
per key: an entry joins the node whose bytes are equal, or becomes a new node.
The nodes are written to the shared folder as the index, and every row looks
its group up by (key, digest).

Hot groups: a map task sends one entry per text and 32 MB of input, whatever
the number of copies, and an owner holds one chain at a time; the lookup is a
plain join of two stored tables, which adaptive execution splits when skewed.

Defined cases: null text is equal to the empty text; null ids are smaller than
all others; of rows repeated with the same id and text one stays; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, partitions, stored, text_of

#: Bytes of texts that a map task folds before it sends its entries.
FOLD_BYTES = 32 << 20
#: Directory bits looked at in one pass over the keys.
STEP = 10


class Directory:
    """Buckets as (leading bits, depth); ``slots`` maps the first ``depth``
    bits of a key to the number of its bucket."""

    def __init__(self, buckets: list[tuple[int, int]]):
        self.buckets = sorted(buckets, key=lambda b: b[0] << (63 - b[1]))
        self.depth = max(d for _, d in buckets)
        # Each bucket fills 2**(depth - its depth) neighbouring slots, in key order.
        self.slots = np.repeat(np.arange(len(self.buckets), dtype=np.int32), [1 << (self.depth - d) for _, d in self.buckets])

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        if not self.depth:
            return np.zeros(len(keys), np.int32)
        return self.slots[(keys.view(np.uint64) >> np.uint64(64 - self.depth)).astype(np.int64)]


def build_directory(keys: DataFrame, capacity: int, max_depth: int = 30) -> Directory:
    """``keys``: one row (key, bytes) per different key."""
    done: list[tuple[int, int]] = []
    open_: list[tuple[int, int]] = [(0, 0)]
    depth = 0
    while open_:
        # Only the buckets still overfull are read again, STEP bits deeper.
        below = depth + STEP
        at = lambda bits: F.shiftrightunsigned("key", 64 - bits)
        rows = keys if not depth else keys.where(at(depth).isin([p for p, _ in open_]))
        counted = rows.groupBy(at(below).alias("slot")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).collect()
        load = {r.slot: (r.bytes, r.n) for r in counted}  # at most 2**STEP rows per overfull bucket
        by_depth = {below: load}
        for d in range(below - 1, depth - 1, -1):
            up: dict[int, tuple[int, int]] = {}
            for slot, (b, n) in by_depth[d + 1].items():
                was = up.get(slot >> 1, (0, 0))
                up[slot >> 1] = (was[0] + b, was[1] + n)
            by_depth[d] = up
        still: list[tuple[int, int]] = []
        todo = list(open_)
        while todo:
            prefix, d = todo.pop()
            b, n = by_depth[d].get(prefix, (0, 0))
            if b <= capacity or n <= 1 or d >= max_depth:
                done.append((prefix, d))
            elif d == below:
                still.append((prefix, d))
            else:  # overfull: the directory doubles here and the bucket splits by its next bit
                todo += [(prefix << 1, d + 1), (prefix << 1 | 1, d + 1)]
        open_, depth = still, below
    return Directory(done)


def _larger(a: int | None, b: int | None) -> bool:
    return a is not None and (b is None or a > b)


def _entries(docs: DataFrame, directory: Directory) -> DataFrame:
    """One entry per text and map task (or 32 MB): bucket, key, sha, text,
    rows, largest id; with a column ``rest``, that of the row with that id."""
    shared = docs.sparkSession.sparkContext.broadcast(directory)
    extra = "rest" in docs.columns

    def out(held: dict, rest_type: pa.DataType) -> pa.RecordBatch:
        keys = np.array([k[0] for k in held], np.int64)
        values = list(held.values())
        columns = {
            "bucket": pa.array(shared.value.bucket(keys), pa.int32()),
            "key": pa.array(keys),
            "sha": pa.array([v[0] for v in values], pa.string()),
            "text": pa.array([k[1] for k in held], pa.binary()),
            "n": pa.array([v[1] for v in values], pa.int64()),
            "top": pa.array([v[2] for v in values], pa.int64()),
        }
        if extra:
            columns["rest"] = pa.array([v[3] for v in values], rest_type)
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], list] = {}
        size, kind = 0, pa.null()
        for batch in batches:
            rests = [None] * batch.num_rows
            if extra:
                kind, rests = batch.column("rest").type, batch.column("rest").to_pylist()
            for i, key, sha, text, rest in zip(*(batch.column(c).to_pylist() for c in ("id", "key", "sha", "t")), rests, strict=True):
                node = held.get((key, text))
                if node is None:
                    held[key, text] = [sha, 1, i, rest]
                    size += len(text)
                else:
                    node[1] += 1
                    if _larger(i, node[2]):
                        node[2:] = i, rest
                if size >= FOLD_BYTES:
                    yield out(held, kind)
                    held, size = {}, 0
        if held:
            yield out(held, kind)

    kinds = "bucket int, key bigint, sha string, text binary, n bigint, top bigint"
    return map_arrow(docs, run, kinds + (f", rest {docs.schema['rest'].dataType.simpleString()}" if extra else ""))


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of one owner; its entries come in key order."""
    for nodes, _ in _chains(batches):
        cols = list(zip(*((n[0], n[1], n[3], n[4]) for n in nodes), strict=True))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["key", "sha", "group_size", "keep_id"])


def _own_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As above, but the kept rows themselves: (rest, text)."""
    for nodes, kind in _chains(batches):
        yield pa.RecordBatch.from_arrays([pa.array([n[5] for n in nodes], kind), pa.array([n[2] for n in nodes], pa.binary())], ["rest", "text"])


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[list], pa.DataType]]:
    """Closed nodes [key, sha, text, rows, largest id, rest], some at a time."""
    done: list[list] = []
    chain: list[list] = []
    size, key, kind = 0, None, pa.null()
    for batch in batches:
        extra = "rest" in batch.schema.names
        kind = batch.column("rest").type if extra else kind
        rests = batch.column("rest").to_pylist() if extra else [None] * batch.num_rows
        for k, sha, text, n, top, rest in zip(*(batch.column(c).to_pylist() for c in ("key", "sha", "text", "n", "top")), rests, strict=True):
            if k != key:
                done += chain
                key, chain = k, []
                if size >= FOLD_BYTES // 4:
                    yield done, kind
                    done, size = [], 0
            for node in chain:
                if node[2] == text:  # same bytes: a copy
                    node[3] += n
                    if _larger(top, node[4]):
                        node[4:] = top, rest
                    break
            else:
                if any(node[1] == sha for node in chain):
                    raise ValueError(f"different texts with the digest {sha}")
                chain.append([k, sha, text, n, top, rest])
                size += len(text) + 200
    done += chain
    if done:
        yield done, kind


def _owned_entries(rows: DataFrame, keys: DataFrame, capacity: int) -> DataFrame:
    """The entries of ``rows`` (id, key, sha, t[, rest]) with their owners, in key order."""
    directory = build_directory(keys, capacity)
    owners = max(partitions(rows.sparkSession), len(directory.buckets))
    return _entries(rows, directory).repartition(owners, "bucket").sortWithinPartitions("key", "sha")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 32 << 20) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row."""
    text = text_of(text_col)
    rows = stored(
        docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t")).select(
            "id", F.xxhash64("t").alias("key"), F.sha2("t", 256).alias("sha"), F.octet_length("t").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("rid")
        ),
        "exact-rows",
    )
    keys = rows.groupBy("key").agg(F.max("bytes").alias("bytes"))
    whole = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t")).select("id", F.xxhash64("t").alias("key"), F.sha2("t", 256).alias("sha"), "t")
    owned = _owned_entries(whole, keys, capacity)
    index = stored(map_arrow(owned, _own, "key bigint, sha string, group_size bigint, keep_id bigint"), "exact-index")
    # Dealt by (sha, id), which the join's partitioning does not satisfy: the join stays free to be split.
    again = Window.partitionBy("sha", "id").orderBy("rid")
    return (
        rows.join(index, ["key", "sha"])
        .withColumn("nth", F.row_number().over(again))
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 32 << 20) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of equal texts the one with
    the largest id. The owners that compare the bytes hand the rows on, so the
    texts travel once. A null text that stays is empty."""
    others = [c for c in docs.columns if c != text_col]
    whole = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")).select(
        "id", F.xxhash64("t").alias("key"), F.sha2("t", 256).alias("sha"), "t", "rest"
    )
    keys = docs.select(text_of(text_col).alias("t")).select(F.xxhash64("t").alias("key"), F.octet_length("t").cast("long").alias("bytes")).groupBy("key").agg(F.max("bytes").alias("bytes"))
    kept = map_arrow(_owned_entries(whole, keys, capacity), _own_rows, f"rest {whole.schema['rest'].dataType.simpleString()}, text binary")
    return kept.select(*[F.col("text").cast("string").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
