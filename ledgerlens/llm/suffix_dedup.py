"""Suffix-array deduplication: bytes of long repeats of earlier documents go.

A byte is removed when it is covered by a ``length``-byte string that also
starts in a document with a smaller id; strings are judged on the input.

The heart is a Burrows-Wheeler transform of a block of short contexts and a
breadth-first backward extension of its intervals: level by level it marks
where neighbouring suffixes share fewer than 0, 1, 2, ... bytes, and it stops
at ``length``. What lies between marks then shares at least ``length`` bytes;
every such suffix from another than the smallest document is a repeat.

Spark brings the contexts together. A window's smallest k-gram hash (its
anchor) depends on its bytes only, so equal windows have equal anchors, and
successive windows with one anchor form a context of some 70 bytes:

1. Map tasks send (anchor, context hash, id) of their contexts as packed
   arrays to owners of anchor ranges, each equal context once per batch. An
   owner answers, per document: this context stands in a smaller document as a
   whole, or: other contexts share its anchor, bring its bytes.
2. The bytes asked for (edges of repeats, mostly) are gathered by anchor, and
   the block transform finds the repeated windows among them. A commonplace
   anchor is cut into several blocks; windows left over there are compared
   through their 128-bit hashes, which Spark aggregates.
3. Documents join their answers, and the covered bytes are cut out.

Of equal texts only the one with the smallest id is worked on: all bytes of
the others go. No anchor, however common, gathers in one task: owners get one
entry per context and batch, blocks are bounded.

Defined cases: a null text is empty; texts shorter than ``length`` keep all;
a null id counts as smaller than all others; rows repeated with one id never
repeat each other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_view, map_arrow, mix64, partitions, powers, rolling_sums, slices, span_hashes, stored, text_of
from .common import _BASE_INVERSE as INVERSE

#: Bytes of the k-grams that anchors are chosen from.
GRAM = 20
#: Longest run of windows in one context (periodic texts have endless runs).
RUN = 2048
#: Context bytes in one transform; contexts of one anchor in one block.
BLOCK_BYTES, SALT = 1 << 18, 8192
#: Bytes of entries in one anchor range; text bytes whose entries a map task sends together,
#: and whose contexts are found together.
RANGE_BYTES, SENT_BYTES, PART_BYTES = 4 << 20, 3 << 20, 1 << 18
LOWEST = -(1 << 63)


# --- the transform ---------------------------------------------------------


def suffix_order(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of ``data`` in the order of their suffixes, each suffix reaching
    to its context's end (``ends``: that end for every place); equal suffixes
    by place. By prefix doubling from seven bytes."""
    n = len(data)
    place = np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(7):  # nine bits a byte: 0 stands behind the end
        at = np.minimum(place + k, n - 1)
        symbol = np.where(place + k < ends, data[at].astype(np.uint64) + np.uint64(1), np.uint64(0))
        key = key << np.uint64(9) | symbol
    longest = int((ends - place).max()) if n else 0
    reach = 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        if int(rank[order[-1]]) == n:
            return order
        if reach >= longest:
            return np.argsort(rank * np.uint64(n) + place.astype(np.uint64))
        behind = place + reach
        key = rank * np.uint64(n + 1) + np.where(behind < ends, rank[np.minimum(behind, n - 1)], np.uint64(0))
        reach *= 2


def split_below(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, marks): ``marks[i]`` says that the i-th suffix shares
    fewer than ``length`` bytes with the one before it.

    Level l holds the intervals of strings of l bytes whose right end was
    marked at that level. Extending one to the left by each byte that precedes
    its suffixes (their images under the LF mapping lie side by side) gives the
    intervals of level l + 1; an end already marked adds nothing new.
    """
    n = len(data)
    order = suffix_order(data, ends)
    starts = np.ones(n, bool)  # places with no byte of their context before them
    starts[1:] = ends[1:] != ends[:-1]
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    back = np.where(starts[order], -1, where[order - 1])  # the LF mapping
    initial = data[order]
    marks = np.zeros(n + 1, bool)
    first, last = np.array([0]), np.array([n])
    # Level 0: the intervals of single bytes.
    cut = np.flatnonzero(np.concatenate([[True], initial[1:] != initial[:-1], [True]])) if n else np.array([0])
    first, last = cut[:-1], cut[1:]
    marks[cut] = True
    owner = np.empty(n, np.int64)
    for _ in range(1, length):
        if not len(first):
            break
        size = last - first
        which = np.repeat(np.arange(len(first)), size)
        rows = np.arange(len(which)) + np.repeat(first - (np.cumsum(size) - size), size)
        to = back[rows]
        inner = to >= 0
        to, which = to[inner], which[inner]
        if not len(to):
            break
        if len(to) > n // 8:
            seen = np.zeros(n, bool)
            seen[to] = True
            at = np.flatnonzero(seen)
        else:
            at = np.sort(to)
        owner[to] = which
        own = owner[at]
        new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (own[1:] != own[:-1]) | (initial[at[1:]] != initial[at[:-1]])])
        begin = np.flatnonzero(new)
        left, right = at[begin], at[np.append(begin[1:], len(at)) - 1] + 1
        fresh = ~marks[right]
        first, last = left[fresh], right[fresh]
        marks[last] = True
    return order, marks[:n]


def repeated_windows(contexts: list[bytes], ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the contexts that repeat one of a smaller id:
    (context, offset) of those, and of the remaining ones (all of the smallest id)."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    stops = np.cumsum(sizes)
    context = np.repeat(np.arange(len(contexts)), sizes)
    ends = stops[context]
    order, marks = split_below(data, ends, length)
    block = np.cumsum(marks)
    valid = ends[order] - order >= length
    rows, block = order[valid], block[valid]
    who = ids[context[rows]]
    by = np.lexsort((who, block))
    rows, block, who = rows[by], block[by], who[by]
    head = np.concatenate([[True], block[1:] != block[:-1]]) if len(rows) else np.empty(0, bool)
    smallest = who[head][np.cumsum(head) - 1] if len(rows) else who
    again = who > smallest
    offset = rows - (stops - sizes)[context[rows]]
    return context[rows[again]], offset[again], context[rows[~again]], offset[~again]


# --- contexts --------------------------------------------------------------


def contexts_of(flat: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first byte, end, anchor, context hash) of the contexts of all rows."""
    n = len(flat)
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    gram = min(GRAM, length)
    sums = rolling_sums(flat)
    least = mix64((sums[gram:] - sums[:-gram]) * powers(n, INVERSE)[: n - gram + 1])
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if width > have:
        rest = width - have
        least = np.minimum(least[:-rest], least[rest:])
    # Windows that reach over a row's end are none.
    change = np.zeros(len(least) + 1, np.int32)
    inner = offsets[1:-1]
    np.add.at(change, np.clip(inner - length + 1, 0, len(least)), 1)
    np.add.at(change, np.minimum(inner, len(least)), -1)
    place = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    if not len(place):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    anchor = least[place]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(place)))
    if size.max() > RUN:
        parts = -(-size // RUN)
        begin = np.repeat(begin, parts) + RUN * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        size = np.diff(np.append(begin, len(place)))
    first = place[begin]
    end = first + size - 1 + length
    row = np.searchsorted(offsets, first, "right") - 1
    return row, first, end, anchor[begin], span_hashes(flat, first, end, sums)


def _pack(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.reshape(-1).view(np.uint64)


def _width(largest: int) -> int:
    return max(1, -(-int(largest).bit_length() // 8))


_ENTRIES = pa.schema([("range", pa.int32()), ("part", pa.int64()), ("base", pa.int64()), ("width", pa.int32()), ("n", pa.int32()), ("anchors", pa.binary()), ("contexts", pa.binary()), ("ids", pa.binary())])
_ANSWERS = pa.schema([("part", pa.int64()), ("base", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("contexts", pa.binary()), ("salts", pa.binary()), ("keys", pa.binary())])
#: Salts: this context is repeated as a whole; else 0, or the block of a cut anchor plus 1.
WHOLE = 0xFFFF
_ENTRY_SQL = "range int, part bigint, base bigint, width int, n int, anchors binary, contexts binary, ids binary"
_ANSWER_SQL = "part bigint, base bigint, width int, ids binary, contexts binary, salts binary, keys binary"


def _spread(anchors: np.ndarray) -> np.ndarray:
    """Anchors as numbers that ranges divide evenly: being the smallest hashes
    of their windows, most anchors are small numbers themselves."""
    return mix64(anchors ^ np.uint64(0x9E3779B97F4A7C15))


def _entries(docs: DataFrame, length: int, ranges: int, anchor_width: int) -> DataFrame:
    """Packed entries per anchor range; range -1: the names of a batch's
    documents; range -2: contexts that the batch itself shows to be repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", SENT_BYTES):
                number, turn = (task << 24) + turn, turn + 1
                ids, keys = part.column("ord").to_numpy(), part.column("key").to_numpy()
                found, done = [], 0
                for small in slices(part, "text", PART_BYTES):
                    got = contexts_of(*binary_view(small.column("text")), length)
                    found.append((got[0] + done, got[3], got[4]))
                    done += small.num_rows
                row, anchor, context = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
                out = [{"range": -1, "part": number, "base": 0, "width": 8, "n": len(ids), "anchors": keys.tobytes(), "contexts": b"", "ids": ids.tobytes()}]
                if len(row):
                    anchor = _spread(anchor) >> np.uint64(64 - 8 * anchor_width)
                    who = ids[row]
                    by = np.lexsort((who, context, anchor))
                    anchor, context, who = anchor[by], context[by], who[by]
                    head = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])])
                    fresh = head | np.concatenate([[True], who[1:] != who[:-1]])  # once per document
                    anchor, context, who, head = anchor[fresh], context[fresh], who[fresh], head[fresh]
                    base = int(ids.min())
                    far = who.view(np.uint64) - np.uint64(base & (2**64 - 1))
                    width = _width(int(far.max()))
                    if not head.all():
                        out.append({"range": -2, "part": number, "base": base, "width": width, "n": 0, "anchors": b"", "contexts": _pack(context[~head], 8), "ids": _pack(far[~head], width)})
                    anchor, context, far = anchor[head], context[head], far[head]
                    where = (anchor.astype(np.float64) * (ranges / 2.0 ** (8 * anchor_width))).astype(np.int64).clip(0, ranges - 1)
                    cuts = np.searchsorted(where, np.arange(ranges + 1))  # anchors are in order
                    for r in np.flatnonzero(np.diff(cuts)):
                        a, b = cuts[r], cuts[r + 1]
                        gaps = np.diff(anchor[a:b], prepend=np.uint64(0))
                        lead, gaps = int(gaps[0]), gaps[1:]
                        gap_width = _width(int(gaps.max())) if len(gaps) else 1
                        packed = lead.to_bytes(8, "little") + bytes([gap_width]) + _pack(gaps, gap_width)
                        out.append({"range": int(r), "part": number, "base": base, "width": width, "n": int(b - a), "anchors": packed, "contexts": _pack(context[a:b], 8), "ids": _pack(far[a:b], width)})
                yield pa.RecordBatch.from_pylist(out, _ENTRIES)

    return map_arrow(docs, run, _ENTRY_SQL)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners of anchor ranges: which contexts are repeats, which are asked
    for. Rows come by range; one range is held at a time."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["range"] == -1:
                yield _one({"part": row["part"], "base": 0, "width": 8, "ids": row["ids"], "contexts": b"", "salts": b"", "keys": row["anchors"]})
            elif row["range"] == -2:
                n = len(row["contexts"]) // 8
                yield _one({"part": row["part"], "base": row["base"], "width": row["width"], "ids": row["ids"], "contexts": row["contexts"], "salts": _pack(np.full(n, WHOLE), 2), "keys": b""})
            else:
                if row["range"] != now:
                    yield from _answered(held)
                    now, held = row["range"], []
                held.append(row)
    yield from _answered(held)


def _answered(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    """The answers to one range's entries."""
    if not rows:
        return
    anchors, contexts, ids, parts, bases = [], [], [], [], {}
    for row in rows:
        packed = row["anchors"]
        gaps = _unpack(packed[9:], packed[8])
        anchors.append(np.cumsum(np.concatenate([[np.uint64(int.from_bytes(packed[:8], "little"))], gaps]), dtype=np.uint64))
        contexts.append(_unpack(row["contexts"], 8))
        far = _unpack(row["ids"], row["width"])
        ids.append((far + np.uint64(row["base"] & (2**64 - 1))).view(np.int64))
        parts.append(np.full(row["n"], row["part"]))
        bases[row["part"]] = (row["base"], row["width"])
    a, c, who, part = (np.concatenate(x) for x in (anchors, contexts, ids, parts))
    by = np.lexsort((who, c, a))
    a, c, who, part = a[by], c[by], who[by], part[by]
    new_a = np.concatenate([[True], a[1:] != a[:-1]])
    new_c = new_a | np.concatenate([[True], c[1:] != c[:-1]])
    at_a, at_c = np.cumsum(new_a) - 1, np.cumsum(new_c) - 1
    smallest = who[new_c]
    whole = who > smallest[at_c]
    different = np.bincount(at_a[new_c])  # contexts under each anchor
    low = np.minimum.reduceat(smallest, np.flatnonzero(new_a[new_c]))
    high = np.maximum.reduceat(smallest, np.flatnonzero(new_a[new_c]))
    asked = ~whole & ((different > 1) & (low < high))[at_a]
    blocks = -(-different // SALT)
    salt = np.where(blocks[at_a] > 1, (c % blocks[at_a].astype(np.uint64)).astype(np.int64) % (WHOLE - 1) + 1, 0)
    flag = np.where(whole, WHOLE, salt)
    send = whole | asked
    c, who, part, flag = c[send], who[send], part[send], flag[send]
    by = np.argsort(part, kind="stable")
    c, who, part, flag = c[by], who[by], part[by], flag[by]
    for k, i, j in _runs(part):
        base, width = bases[k]
        far = who[i:j].view(np.uint64) - np.uint64(base & (2**64 - 1))
        yield _one({"part": k, "base": base, "width": width, "ids": _pack(far, width), "contexts": _pack(c[i:j], 8), "salts": _pack(flag[i:j], 2), "keys": b""})


def _one(row: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([row], _ANSWERS)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if len(values):
        cuts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
        for i, j in zip(cuts, cuts[1:], strict=False):
            yield int(values[i]), int(i), int(j)


def _todo(answers: DataFrame) -> DataFrame:
    """(ord, key, whole, asked, salts): the answers to each document; packed context hashes."""
    dealt = answers.repartition(partitions(answers.sparkSession), "part").sortWithinPartitions("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    yield from _dealt(rows)
                    part, rows = row["part"], []
                rows.append(row)
        yield from _dealt(rows)

    return map_arrow(dealt, run, "ord bigint, key bigint, whole binary, asked binary, salts binary")


def _dealt(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    if not rows:
        return
    names = next(r for r in rows if r["keys"])
    ids, keys = np.frombuffer(names["ids"], np.int64), np.frombuffer(names["keys"], np.int64)
    got = [r for r in rows if not r["keys"]]
    if not got:
        return
    c = np.concatenate([_unpack(r["contexts"], 8) for r in got])
    flag = np.concatenate([_unpack(r["salts"], 2) for r in got]).astype(np.int64)
    who = np.concatenate([(_unpack(r["ids"], r["width"]) + np.uint64(r["base"] & (2**64 - 1))).view(np.int64) for r in got])
    by = np.lexsort((c, who))
    c, flag, who = c[by], flag[by], who[by]
    low, high = np.searchsorted(who, ids, "left"), np.searchsorted(who, ids, "right")
    out = []
    for i, key, a, b in zip(ids.tolist(), keys.tolist(), low, high, strict=True):
        if b > a:
            all_of = flag[a:b] == WHOLE
            out.append({"ord": i, "key": key, "whole": _pack(c[a:b][all_of], 8), "asked": _pack(c[a:b][~all_of], 8), "salts": _pack(flag[a:b][~all_of], 2)})
    if out:
        yield pa.RecordBatch.from_pylist(out, pa.schema([("ord", pa.int64()), ("key", pa.int64()), ("whole", pa.binary()), ("asked", pa.binary()), ("salts", pa.binary())]))


# --- bytes -----------------------------------------------------------------


def _packed_texts(docs: DataFrame) -> DataFrame:
    """(ord, key, z[, rest]): texts compressed for the way to their answers."""
    extra = ["rest"] if "rest" in docs.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = pa.array([packer.compress(t) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("ord"), batch.column("key"), z, *(batch.column(c) for c in extra)], ["ord", "key", "z", *extra])

    rest = "".join(f", rest {docs.schema[c].dataType.simpleString()}" for c in extra)
    return map_arrow(docs.select("ord", "key", "text", *extra), run, "ord bigint, key bigint, z binary" + rest)


def _member(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``wanted``, as places there (-1: not)."""
    if not len(wanted):
        return np.full(len(values), -1)
    at = np.searchsorted(wanted, values)
    at[at == len(wanted)] = 0
    return np.where(wanted[at] == values, at, -1)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of the unpacked texts of a batch, about
    ``PART_BYTES`` at a time."""
    import zstandard

    reader = zstandard.ZstdDecompressor()
    first, held, size = 0, [], 0
    for i, z in enumerate(batch.column("z").to_pylist()):
        held.append(reader.decompress(z))
        size += len(held[-1])
        if size >= PART_BYTES or len(held) >= 1 << 15 or i == batch.num_rows - 1:
            yield first, np.frombuffer(b"".join(held), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in held])])
            first, held, size = i + 1, [], 0


def _named(row: np.ndarray, context: np.ndarray) -> np.ndarray:
    """A number for a context of a row."""
    return mix64(context ^ mix64(row.astype(np.uint64) + np.uint64(1)))


def _asked_contexts(rows: DataFrame, length: int) -> DataFrame:
    """(anchor, salt, ord, key, context, bytes) of the contexts asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("ord").to_numpy(), batch.column("key").to_numpy()
            asked, salts = batch.column("asked").to_pylist(), batch.column("salts").to_pylist()
            for base, flat, offsets in _texts(batch):
                n = len(offsets) - 1
                wanted = [_unpack(a, 8) for a in asked[base : base + n]]
                names = _named(np.repeat(np.arange(n), [len(w) for w in wanted]), np.concatenate(wanted))
                salt = np.concatenate([_unpack(x, 2) for x in salts[base : base + n]]).astype(np.int32)
                order = np.argsort(names)
                names, salt = names[order], salt[order]
                row, first, end, anchor, context = contexts_of(flat, offsets, length)
                own = _named(row, context)
                at = _member(own, names)
                hit = np.flatnonzero(at >= 0)
                hit = hit[np.unique(own[hit], return_index=True)[1]]
                who = row[hit] + base
                sizes = end[hit] - first[hit]
                ends = np.cumsum(sizes)
                data = flat[np.arange(sizes.sum()) + np.repeat(first[hit] - (ends - sizes), sizes)]
                column = pa.Array.from_buffers(pa.binary(), len(hit), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[hit].view(np.int64)), pa.array(salt[at[hit]]), pa.array(ids[who]), pa.array(keys[who]), pa.array(context[hit].view(np.int64)), column],
                    ["anchor", "salt", "ord", "key", "context", "bytes"],
                )

    return map_arrow(rows, run, "anchor bigint, salt int, ord bigint, key bigint, context bigint, bytes binary")


def _hopeful(anchors: np.ndarray, ids: np.ndarray, contexts: list[bytes], length: int) -> np.ndarray:
    """Which contexts may share a window with one of another document. A window
    reaches at least ``half`` bytes to the left or to the right of its anchor's
    k-gram, so one of the two must agree at some place of the k-gram in either;
    a context that holds the k-gram twice is always kept."""
    gram = min(GRAM, length)
    half = -(-(length - gram) // 2)
    sizes = np.array([len(c) for c in contexts], np.int64)
    stops = np.cumsum(sizes)
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    sums = rolling_sums(flat)
    hashes = mix64((sums[gram:] - sums[:-gram]) * powers(len(flat), INVERSE)[: len(flat) - gram + 1])
    context = np.repeat(np.arange(len(contexts)), sizes)[: len(hashes)]
    at = np.flatnonzero((hashes == anchors[context]) & (np.arange(len(hashes)) + gram <= stops[context]))
    times = np.bincount(context[at], minlength=len(contexts))
    keep = times != 1
    owner = context[at]
    for begin, end in ((at - half, at), (at + gram, at + gram + half)):
        inside = (begin >= (stops - sizes)[owner]) & (end <= stops[owner])
        side = span_hashes(flat, begin[inside], end[inside], sums) ^ mix64(anchors[owner[inside]])
        who = owner[inside]
        order = np.argsort(side)
        side, who = side[order], who[order]
        start = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]])) if len(side) else np.empty(0, np.int64)
        if len(start):
            low, high = np.minimum.reduceat(ids[who], start), np.maximum.reduceat(ids[who], start)
            keep[who[np.repeat(low < high, np.diff(np.append(start, len(side))))]] = True
    return keep


def _compare(asked: DataFrame, length: int) -> DataFrame:
    """Repeated windows among the contexts of each (anchor, salt), as (ord,
    key, context, first, last offset); with (h1, h2) set: a window of a cut
    anchor in the smallest document of its block, wherever it stands there."""
    dealt = asked.repartition(partitions(asked.sparkSession), "anchor", "salt").sortWithinPartitions("anchor", "salt")
    names = ["ord", "key", "context", "first", "last", "h1", "h2"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def flush(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        anchors = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        ids = np.array([r[2] for r in rows], np.int64)
        salted = np.array([r[1] > 0 for r in rows])
        keep = _hopeful(anchors, ids, [r[5] for r in rows], length) | salted
        rows, ids, salted = [r for r, k in zip(rows, keep.tolist(), strict=True) if k], ids[keep], salted[keep]
        if not rows:
            return
        again, at, left, left_at = repeated_windows([r[5] for r in rows], ids, length)
        out = []
        by = np.lexsort((at, again))
        again, at = again[by], at[by]
        if len(again):
            new = np.flatnonzero(np.concatenate([[True], (again[1:] != again[:-1]) | (at[1:] != at[:-1] + 1)]))
            for i, j in zip(new, np.append(new[1:], len(again)), strict=True):
                r = rows[again[i]]
                out.append((r[2], r[3], r[4], int(at[i]), int(at[j - 1]), None, None))
        for k, offset in zip(left[salted[left]].tolist(), left_at[salted[left]].tolist(), strict=True):
            r = rows[k]
            h = np.frombuffer(hashlib.blake2b(r[5][offset : offset + length], digest_size=16).digest(), "<i8")
            out.append((r[2], r[3], r[4], offset, offset, int(h[0]), int(h[1])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Blocks end between anchors; a salt bounds what one of them holds.
                if size >= BLOCK_BYTES and row[:2] != held[-1][:2]:
                    yield from flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield from flush(held)

    return map_arrow(dealt, run, ", ".join(f"{n} bigint" for n in names))


def _stays(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets, which bytes stay), some texts at a time, from
    their answers ``whole`` and ``parts``."""
    whole, parts = batch.column("whole").to_pylist(), batch.column("parts").to_pylist()
    for base, flat, offsets in _texts(batch):
        n = len(offsets) - 1
        row, first, end, _, context = contexts_of(flat, offsets, length)
        own = _named(row, context)
        sure = [_unpack(w or b"", 8) for w in whole[base : base + n]]
        hit = _member(own, np.sort(_named(np.repeat(np.arange(n), [len(w) for w in sure]), np.concatenate(sure)))) >= 0
        begin, stop = [first[hit]], [end[hit]]
        known = np.array([(i, p["context"], p["first"], p["last"]) for i, some in enumerate(parts[base : base + n]) for p in some or ()], np.int64).reshape(-1, 4)
        if len(known):
            names = _named(known[:, 0], known[:, 1].view(np.uint64))
            order = np.argsort(names, kind="stable")
            known, names = known[order], names[order]
            low, high = np.searchsorted(names, own, "left"), np.searchsorted(names, own, "right")
            times = high - low
            at = np.repeat(np.arange(len(own)), times)
            which = np.arange(len(at)) + np.repeat(low - (np.cumsum(times) - times), times)
            begin.append(first[at] + known[which, 2])
            stop.append(first[at] + known[which, 3] + length)
        change = np.zeros(len(flat) + 1, np.int32)
        np.add.at(change, np.concatenate(begin), 1)
        np.add.at(change, np.concatenate(stop), -1)
        yield base, flat, offsets, np.cumsum(change[:-1]) == 0


def _cut_out(rows: DataFrame, length: int) -> DataFrame:
    """The digest columns of ``rows``: (ord, key, z, whole, parts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, shas = [], [], []
            for _, flat, offsets, stays in _stays(batch, length):
                for a, b in zip(offsets, offsets[1:], strict=False):
                    own = stays[a:b]
                    removed.append(int(b - a - own.sum()))
                    spans.append(int((~own[:1]).sum() + (own[:-1] & ~own[1:]).sum()))
                    shas.append(hashlib.sha256(flat[a:b][own].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("ord"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string())],
                ["ord", "key", "removed", "spans", "sha"],
            )

    return map_arrow(rows, run, "ord bigint, key bigint, removed bigint, spans bigint, sha string")


def _answers(source: DataFrame, total: int, firsts: DataFrame, length: int) -> DataFrame:
    """(ord, key, whole, parts) of the first of equal texts, where bytes go.
    ``source``: (ord, key, text); ``firsts``: (ord, key)."""
    spark = source.sparkSession
    anchors = max(1, total // 16)
    anchor_width = min(7, _width(anchors) + 1 + (anchors.bit_length() % 8 > 4))
    ranges = int(max(partitions(spark), -(-anchors * 16 // RANGE_BYTES)))
    entries = _entries(source, length, ranges, anchor_width)
    dealt = entries.repartition(ranges, F.when(F.col("range") >= 0, F.col("range")).otherwise(F.col("part"))).sortWithinPartitions("range")
    answers = map_arrow(dealt, _answer, _ANSWER_SQL)
    # Only the smallest of equal texts is worked on.
    todo = stored(_todo(answers).dropDuplicates(["ord", "key"]).join(firsts, ["ord", "key"], "left_semi"), "suffix-todo")
    asked = _packed_texts(source).join(todo.where(F.octet_length("asked") > 0).select("ord", "key", "asked", "salts"), ["ord", "key"])
    found = stored(_compare(_asked_contexts(asked, length), length), "suffix-windows")
    parts = found.where("h1 is null").select("ord", "key", "context", "first", "last")
    cut = found.where("h1 is not null")
    least = cut.groupBy("h1", "h2").agg(F.min("ord").alias("least"), F.count("*").alias("n")).where("n > 1")
    parts = parts.union(cut.join(least, ["h1", "h2"]).where("ord > least").select("ord", "key", "context", "first", "last"))
    listed = parts.groupBy("ord", "key").agg(F.collect_list(F.struct("context", "first", "last")).alias("parts"))  # at most a document's own windows
    return todo.select("ord", "key", "whole").join(listed, ["ord", "key"], "left").where((F.octet_length("whole") > 0) | F.col("parts").isNotNull())


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ord (a null id as the lowest number), key and text as bytes."""
    ord_ = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("ord")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")
    return docs.select(ord_, text_of(text_col).alias("text"), others).withColumn("key", F.xxhash64("text"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    source = _source(docs, id_col, text_col)
    rows = stored(source.select(F.col("rest")[id_col].cast("long").alias("id"), "ord", "key", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("sha0")), "suffix-rows")
    total = int(rows.agg(F.sum("n")).first()[0] or 0)
    firsts = stored(rows.groupBy("sha0").agg(F.min("ord").alias("ord"), F.min("key").alias("key")), "suffix-firsts")
    work = _packed_texts(source.drop("rest")).join(_answers(source.select("ord", "key", "text"), total, firsts.select("ord", "key"), length), ["ord", "key"])
    cuts = stored(_cut_out(work, length).dropDuplicates(["ord", "key"]), "suffix-cuts")
    copy = (F.col("ord") > F.col("first_ord")) & (F.col("n") >= length)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    out = rows.join(firsts.select("sha0", F.col("ord").alias("first_ord")), "sha0").join(cuts, ["ord", "key"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_bytes"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, none).otherwise(F.coalesce("sha", "sha0")).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, chars_col: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with the text that remains; of a
    character that a cut leaves in pieces nothing remains. ``chars_col``, if
    given, is set to the new number of characters."""
    source = _source(docs, id_col, text_col)
    rows = stored(source.select("ord", "key", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("sha0")), "suffix-rows")
    total = int(rows.agg(F.sum("n")).first()[0] or 0)
    firsts = stored(rows.groupBy("sha0").agg(F.min("ord").alias("ord"), F.min("key").alias("key")), "suffix-firsts")
    answers = _answers(source.select("ord", "key", "text"), total, firsts.select("ord", "key"), length).withColumn("gone", F.lit(False))
    copies = rows.where(F.col("n") >= length).join(firsts.select("sha0", F.col("ord").alias("first_ord")), "sha0").where("ord > first_ord").select("ord", "key").distinct()
    answers = stored(answers.unionByName(copies.withColumn("gone", F.lit(True)), allowMissingColumns=True), "suffix-answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            gone = batch.column("gone").to_pylist()
            for base, flat, offsets, stays in _stays(batch, length):
                for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
                    own = stays[a:b]
                    kept = flat[a:b] if own.all() else flat[a:b][own]
                    texts.append("" if gone[base + i] else kept.tobytes().decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.string())], ["rest", "text"])

    joined = _packed_texts(source).join(answers, ["ord", "key"], "left")
    cleaned = map_arrow(joined.select("z", "whole", "parts", "gone", "rest"), run, f"rest {source.schema['rest'].dataType.simpleString()}, text string")
    new = {text_col: F.col("text"), **({chars_col: F.char_length("text").cast("long")} if chars_col else {})}
    return cleaned.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
