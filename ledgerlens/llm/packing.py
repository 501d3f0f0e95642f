"""Best-fit packing of tokenised documents, after dominance reduction.

Tokenising is a map over whole texts; a document longer than a sequence is cut
so that only its first piece may be short. The plan needs nothing but how many
pieces there are of each length, so one count per length (at most ``capacity``
numbers) reaches the driver. There the instance is first reduced as Martello
and Toth do: taking the largest piece, a set that provably dominates every
other set holding that piece is fixed as a full sequence. What remains is
packed best-fit decreasing. Both work on counts, so thousands of equal pieces
are placed in one step.

The plan is a list of patterns (lengths in a sequence) with multiplicities.
Pieces of one length are interchangeable: a piece takes the place that its
rank among the pieces of its length names. Ranks come from a running count
inside each task plus the counts of the tasks before, so no length, however
common, is gathered in one task.

Defined cases: a null text is empty and packs its end token alone; repeated
rows are packed again; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored, text_of

# --- the plan, on counts ---------------------------------------------------


def _reachable(lengths: list[int], limit: int) -> int:
    """Bit set of all sums up to ``limit`` of the lengths, each any number of times."""
    mask = (1 << (limit + 1)) - 1
    sums = 1
    for length in lengths:
        while True:
            more = (sums | sums << length) & mask
            if more == sums:
                break
            sums = more
    return sums


def reduce_dominated(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix sequences that provably dominate all others holding the same piece;
    their pieces leave ``counts``.

    For the largest piece j with free room r beside it, {j} dominates if
    nothing fits beside it, and {j, k}, k the largest fitting piece, dominates
    if no set of the other pieces fills more of r than k alone: whatever stood
    beside j in another packing fits into the place of k. ``reachable`` lets
    every length be used any number of times, so a set is only fixed if the
    proof holds for any multiplicity.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []
    left = sorted((n for n in counts if counts[n]), reverse=True)
    sums: int | None = None
    skipped = 0
    while skipped < len(left):
        j = left[skipped]
        room = capacity - j
        fitting = [n for n in left if n <= room and counts[n]]
        if not fitting:
            fixed.append(((j,), counts.pop(j)))
            left.remove(j)
            continue
        k = fitting[0]
        if sums is None:
            sums = _reachable(left, capacity)
        best = (sums & ((1 << (room + 1)) - 1)).bit_length() - 1
        if best > k:  # some set may fill more than k: no proof for this piece
            skipped += 1
            continue
        pairs = counts[j] // 2 if j == k else min(counts[j], counts[k])
        if not pairs:  # a single piece left that would pair with itself
            skipped += 1
            continue
        fixed.append(((j, k), pairs))
        for n in {j, k}:
            counts[n] -= 2 * pairs if j == k else pairs
            if not counts[n]:
                left.remove(n)
                del counts[n]
                sums = None
        skipped = 0
    return fixed


def best_fit(counts: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing: each piece, longest first, goes to the fullest
    sequence that still holds it. Equal sequences are one entry with a count."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}  # free room -> pattern -> how many
    closed: Counter = Counter()

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room:
            at = open_.setdefault(room, {})
            at[pattern] = at.get(pattern, 0) + n
        else:
            closed[pattern] += n

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            rooms = [r for r in open_ if r >= length]
            if not rooms:
                each = capacity // length  # new sequences, filled one after the other
                whole, rest = divmod(todo, each)
                if whole:
                    put(capacity - each * length, (length,) * each, whole)
                if rest:
                    put(capacity - rest * length, (length,) * rest, 1)
                todo = 0
                continue
            room = min(rooms)
            pattern, n = open_[room].popitem()
            if not open_[room]:
                del open_[room]
            each = room // length  # best fit keeps filling the sequence it chose
            whole = min(n, todo // each)
            if whole:
                put(room - each * length, pattern + (length,) * each, whole)
                todo -= whole * each
            if whole < n:
                used = min(todo, each) if todo < each else 0
                if used:
                    put(room - used * length, pattern + (length,) * used, 1)
                    todo -= used
                if n - whole - bool(used):
                    put(room, pattern, n - whole - bool(used))
    for at in open_.values():
        closed.update(at)
    return list(closed.items())


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with multiplicities that hold exactly the counted pieces."""
    left = Counter({n: c for n, c in counts.items() if c})
    fixed = reduce_dominated(left, capacity)
    return fixed + best_fit(left, capacity)


# --- tokenising ------------------------------------------------------------


@lru_cache(maxsize=2)
def _own(path: str):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


#: Blanks in a row that the faster implementation is trusted with.
_BLANKS = 2_000


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Text -> token ids of a byte-level BPE file. The file's vocabulary is
    handed to a faster implementation of the same algorithm, which merges in the
    order of ids: that must be the order of the file's merges. Texts with special
    tokens, characters whose class differs between Unicode versions or runs of
    blanks that are too long for its backtracking go through the file's own
    tokenizer."""
    import json
    import re

    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # The byte of each character of the vocabulary file: printable bytes stand for themselves.
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        raise ValueError(f"{path}: the ids of tokens do not follow the order of merges")
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    # Latin, Greek, Cyrillic and general punctuation: settled long before either library's Unicode tables.
    unusual = re.compile("|".join([r"[^\t\n\r -~ -ɏͰ-ͳΑ-ΡΣ-ҁ‐-‧€]", rf"\s{{{_BLANKS},}}", *map(re.escape, special)]))

    def encode(text: str) -> np.ndarray:
        if unusual.search(text):
            return np.array(_own(path).encode(text, add_special_tokens=False).ids, "<u4")
        return fast.encode_to_numpy(text).astype("<u4", copy=False)

    return encode


#: Texts up to this many tokens are remembered while a task runs, up to so many tokens in all.
_KEEP, _KEPT = 2_000, 2_000_000


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, and the piece's
    task and running number among the task's pieces of its length."""
    fields = [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = _encoder(tokenizer)
        task = TaskContext.get().partitionId()
        seen: Counter = Counter()
        known: dict[str, list] = {}
        kept = 0
        for batch in batches:
            out: list[tuple] = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                cut = known.get(text)
                if cut is None:
                    ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                    n = len(ids)
                    first = n % capacity or capacity
                    edges = [0, *range(first, n + 1, capacity)]
                    cut = [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
                    if n <= _KEEP:
                        if kept > _KEPT:
                            known, kept = {}, 0
                        known[text] = cut
                        kept += n
                for k, start, length, crc in cut:
                    out.append((i, k, start, length, crc, task, seen[length]))
                    seen[length] += 1
            columns = list(zip(*out, strict=True)) if out else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return map_arrow(picked, run, "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint")


# --- placing ---------------------------------------------------------------


class Places:
    """For each length, which ranks go to which pattern: ranks [first, next)
    of a length fill one slot of consecutive sequences."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        used: Counter = Counter()
        rows = []
        sequence = 0
        for pattern, n in patterns:
            offset = 0
            for length in pattern:
                rows.append((length, used[length], sequence, offset))
                used[length] += n
                offset += length
            sequence += n
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.length, self.first, self.sequence, self.offset = table.T
        self.sequences = sequence
        # (length, first rank) as one number in order; ranks stay below 2**48.
        self.keys = (self.length << 48) + self.first

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, (length << 48) + rank, "right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    cut = stored(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "packing-pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = docs.sparkSession.sparkContext.broadcast(Places(plan(counts, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["length", "task"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.value.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return map_arrow(ranked, run, f"`{id_col}` bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
