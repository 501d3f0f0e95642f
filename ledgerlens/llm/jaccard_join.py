"""Similarity join of word-shingle sets with a token-group matrix.

Two documents link when the Jaccard similarity of their sets of five-word
shingles is at least ``threshold`` percent. The result names, for every row,
the connected component of its links.

1. Equal sets are one class; only a class representative goes on.
2. Sets are ordered by hash value. Two similar sets share at least ``need`` of
   the first ``prefix`` tokens, so a row with fewer tokens there that occur
   in another row too can have no partner and is left out. This count is made
   from packed arrays, dealt by token ranges.
3. The rest is partitioned into groups of similar documents: documents with
   the same min-hash are compared with a few leaders of their bucket, and
   those that really link form a group (a connected one).
4. The token-group matrix holds each group's token union. A group's overlap
   with the matrix rows of all other groups bounds every member's overlap; a
   group whose bound stays under the threshold is closed. For the rest, a
   document's overlap with another group's union is counted, starting from the
   document's rarest tokens, and only groups with enough of it are opened:
   the document is compared with their members, which gives the exact links
   between groups.
5. Components of the links, carried back to classes and rows.

Copies are never expanded into pairs, groups and token ranges are processed in
bounded blocks, and every step is exact: min-hashes only shape the groups.

Defined cases: a text without words, or null, has an empty set and is alone;
fewer than five words are one shingle; a null id joins its component, which is
named by its smallest non-null id; repeated rows repeat; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_view, blank_table, lowered, map_arrow, mix64, partitions, prime_hashes, ship, slices, stored, text_of, word_hashes
from .components import connected_components

WIDTH = 5
#: Min-hashes per set, and leaders that a bucket compares its documents with.
MINHASHES, LEADERS = 2, 12
#: Documents of one bucket or group handled together.
BLOCK = 2048
#: Bytes of tokens in one token range.
RANGE_BYTES = 4 << 20

_BLANK = blank_table()
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93], np.uint64)


# --- sets ------------------------------------------------------------------


def shingle_sets(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, row offsets): each row's different shingles as sorted 64-bit hashes."""
    n = batch.num_rows
    flat, offsets = binary_view(batch.column(column))
    words, first = word_hashes(lowered(flat), offsets, _BLANK, hashes=prime_hashes)
    counts = np.diff(first)
    rows = np.repeat(np.arange(n), counts)
    last = len(words) - WIDTH + 1
    if last > 0:
        s = words[:last] * _ODD[0]
        for k in range(1, WIDTH):
            s = s + words[k : last + k] * _ODD[k]
        whole = rows[:last] == rows[WIDTH - 1 :]
        tokens, owner = mix64(s[whole]), rows[:last][whole]
    else:
        tokens, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < WIDTH))
    if len(short):
        sums = np.array([(words[first[i] : first[i + 1]] * _ODD[: counts[i]]).sum(dtype=np.uint64) for i in short], np.uint64)
        sums = sums + _ODD[5] * counts[short].astype(np.uint64)
        tokens, owner = np.concatenate([tokens, mix64(sums)]), np.concatenate([owner, short])
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    if len(tokens):
        new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])])
        tokens, owner = tokens[new], owner[new]
    return tokens, np.searchsorted(owner, np.arange(n + 1))


def prefix_length(n: np.ndarray, threshold: int) -> np.ndarray:
    """Tokens of a set of ``n`` that are looked at in step 2."""
    return n - -(-threshold * n // 100) + np.maximum(1, -(-n // 10))


def needed(n, threshold: int):
    """How many of them a similar set must share: a tenth of the smaller set."""
    return np.maximum(1, -(-threshold * n // 1000))


def overlaps(a: np.ndarray, b: np.ndarray) -> int:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(large):
        return 0
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum())


def linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    both = overlaps(a, b)
    return 100 * both >= threshold * (len(a) + len(b) - both)


# --- tokens that occur elsewhere -------------------------------------------

#: What travels to the owner of a token range: packed tokens, the places of
#: their units among ``names``, and the names; range -1: counts known already;
#: range -2: a row's own columns on their way to the table.
_SENT = pa.schema(
    [("range", pa.int32()), ("part", pa.int64()), ("width", pa.int32()), ("tokens", pa.binary()), ("units", pa.binary()), ("names", pa.binary())]
    + [(c, pa.int64()) for c in ("rid", "id", "key", "n", "fp1", "fp2")]
    + [("minhash", pa.list_(pa.int64()))]
)
_SENT_SQL = "range int, part bigint, width int, tokens binary, units binary, names binary, rid bigint, id bigint, key bigint, n bigint, fp1 bigint, fp2 bigint, minhash array<bigint>"
#: What owners return: packed counts of a batch's units, or a row's own columns.
_COUNTED = pa.schema([("part", pa.int64()), ("units", pa.binary()), ("counts", pa.binary())] + list(_SENT)[6:])
_COUNTED_SQL = "part bigint, units binary, counts binary, rid bigint, id bigint, key bigint, n bigint, fp1 bigint, fp2 bigint, minhash array<bigint>"


def token_width(tokens: int) -> int:
    """Bytes that tell so many tokens apart, but for one in a thousand."""
    return min(8, max(3, -(-(max(1, tokens).bit_length() + 10) // 8)))


def _send(tokens: np.ndarray, unit: np.ndarray, names: np.ndarray, part: int, width: int, ranges: int) -> list[dict]:
    """A batch's (token, unit) entries, packed per token range. A token that
    several units of the batch hold is counted here; two entries of it go on,
    without units, only to tell the others."""
    tokens = tokens & np.uint64((1 << (8 * width)) - 1) if width < 8 else tokens
    order = np.lexsort((unit, tokens))
    tokens, unit = tokens[order], unit[order]
    if not len(tokens):
        return []
    new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (unit[1:] != unit[:-1])])
    tokens, unit = tokens[new], unit[new]
    start = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    times = np.diff(np.append(np.flatnonzero(start), len(tokens)))
    many = np.repeat(times > 1, times)
    here = np.bincount(unit[many], minlength=len(names))
    go = ~many | start | np.concatenate([[False], start[:-1]])
    tokens, unit, tell = tokens[go], unit[go], many[go]
    where = ((tokens >> np.uint64(max(0, 8 * width - 24))).astype(np.int64) * ranges) >> min(24, 8 * width)
    cuts = np.searchsorted(where, np.arange(ranges + 1))  # tokens are in order
    out = []
    for r in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[r], cuts[r + 1]
        used, at = np.unique(unit[a:b][~tell[a:b]], return_inverse=True)
        kind = np.uint16 if len(used) < 65_535 else np.uint32
        places = np.full(b - a, np.iinfo(kind).max, kind)
        places[~tell[a:b]] = at
        packed = np.ascontiguousarray(tokens[a:b].view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
        out.append({"range": int(r), "part": part, "width": width, "tokens": packed, "units": places.tobytes(), "names": names[used].tobytes()})
    mine = np.flatnonzero(here)
    if len(mine):
        out.append({"range": -1, "part": part, "width": 0, "tokens": here[mine].astype(np.int64).tobytes(), "units": b"", "names": names[mine].tobytes()})
    return out


def _count(grouped: bool):
    """The owner of token ranges: how many of a unit's tokens other units hold
    too. With ``grouped`` a unit may send entries from several batches. Rows
    come by range; one range is held at a time."""

    def counted(tokens: list, units: list, parts: list) -> Iterator[pa.RecordBatch]:
        t, u, p = np.concatenate(tokens), np.concatenate(units), np.concatenate(parts)
        name = np.where(u == -1, -2 - np.arange(len(u)), u) if grouped else None
        order = np.lexsort((name, t)) if grouped else np.argsort(t, kind="stable")
        t, u, p = t[order], u[order], p[order]
        start = np.concatenate([[True], t[1:] != t[:-1]])
        group = np.cumsum(start) - 1
        if grouped:
            name = name[order]
            units_of = np.bincount(group, start | np.concatenate([[True], name[1:] != name[:-1]]))
        else:
            units_of = np.bincount(group)
        hit = (units_of > 1)[group] & (u != -1)
        if hit.any():
            keys, n = np.unique(np.stack([p[hit], u[hit]], 1), axis=0, return_counts=True)
            yield from _counted(keys[:, 1], n, keys[:, 0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])
        for batch in batches:
            own = batch.filter(pc.equal(batch.column("range"), -2))
            if own.num_rows:
                yield pa.RecordBatch.from_arrays([pa.nulls(own.num_rows, f.type) if k < 3 else own.column(f.name) for k, f in enumerate(_COUNTED)], schema=_COUNTED)
            for row in batch.filter(pc.greater(batch.column("range"), -2)).select(_SENT.names[:6]).to_pylist():
                names = np.frombuffer(row["names"], np.int64)
                if row["range"] < 0:
                    yield from _counted(names, np.frombuffer(row["tokens"], np.int64), np.full(len(names), row["part"]))
                    continue
                if row["range"] != now:
                    if held[0]:
                        yield from counted(*held)
                    now, held = row["range"], ([], [], [])
                wide = np.zeros((len(row["tokens"]) // row["width"], 8), np.uint8)
                wide[:, : row["width"]] = np.frombuffer(row["tokens"], np.uint8).reshape(-1, row["width"])
                kind = np.uint16 if len(row["units"]) == 2 * len(wide) else np.uint32
                places = np.frombuffer(row["units"], kind)
                held[0].append(wide.reshape(-1).view(np.uint64))
                held[1].append(np.where(places == np.iinfo(kind).max, -1, np.append(names, -1)[np.minimum(places, len(names))]))
                held[2].append(np.full(len(wide), row["part"]))
        if held[0]:
            yield from counted(*held)

    return run


def _counted(unit: np.ndarray, n: np.ndarray, part: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per batch that sent entries (``part`` in order)."""
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.empty(0, np.int64)
    rows = [
        {"part": int(part[i]), "units": unit[i:j].astype(np.int64).tobytes(), "counts": n[i:j].astype(np.int32).tobytes()} for i, j in zip(cuts, cuts[1:], strict=False)
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, _COUNTED)


def _summed(counted: DataFrame) -> DataFrame:
    """(unit, shared) per unit and batch, from the packed counts."""
    dealt = counted.where("part is not null").select("part", "units", "counts").repartition(partitions(counted.sparkSession), "part").sortWithinPartitions("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, units, counts = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if units:
                names, at = np.unique(np.concatenate(units), return_inverse=True)
                n = np.bincount(at, np.concatenate(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n)], ["unit", "shared"])

        for batch in batches:
            for k, u, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != part:
                    yield from close()
                    part, units, counts = k, [], []
                units.append(np.frombuffer(u, np.int64))
                counts.append(np.frombuffer(n, np.int32))
        yield from close()

    return map_arrow(dealt, run, "unit bigint, shared bigint")


def _owned(sent: DataFrame, ranges: int, grouped: bool) -> DataFrame:
    """Deal the entries to the owners of their ranges and count."""
    place = F.when(F.col("range") >= 0, F.col("range")).when(F.col("range") == -2, F.col("rid")).otherwise(F.col("part"))
    return map_arrow(sent.repartition(ranges, place).sortWithinPartitions("range"), _count(grouped), _COUNTED_SQL)


def _ranges(spark, tokens: int) -> int:
    return int(max(partitions(spark), -(-tokens * 8 // RANGE_BYTES)))


def _first_pass(docs: DataFrame, threshold: int, tokens: int) -> DataFrame:
    """The table of rows (rid, id, key, size, set fingerprint, min-hashes) and,
    as rows with ``part`` set, how many of a row's first tokens other rows hold."""
    ranges, width = _ranges(docs.sparkSession, tokens * 3 // 10), token_width(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, turn, done = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, at = shingle_sets(part, "text")
                n = np.diff(at)
                some = n > 0
                hashes = np.zeros((part.num_rows, MINHASHES), np.uint64)
                if some.any():
                    for r in range(MINHASHES):
                        hashes[some, r] = np.minimum.reduceat(mix64(tokens ^ _ODD[r]), at[:-1][some])
                digests = [hashlib.blake2b(tokens[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at, at[1:], strict=False)]
                prints = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                rid = (task << 33) + done + np.arange(part.num_rows)
                first = np.where(some, prefix_length(n, threshold), 0)
                owner = np.repeat(np.arange(part.num_rows), n)
                early = np.arange(len(tokens)) - at[owner] < first[owner]
                own = {
                    "range": pa.array(np.full(part.num_rows, -2, np.int32)),
                    "rid": pa.array(rid),
                    "id": part.column("id"),
                    "key": part.column("key"),
                    "n": pa.array(n.astype(np.int64)),
                    "fp1": pa.array(prints[:, 0]),
                    "fp2": pa.array(prints[:, 1]),
                    "minhash": pa.array(list(hashes.view(np.int64)), pa.list_(pa.int64())),
                }
                yield pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(part.num_rows, f.type)) for f in _SENT], schema=_SENT)
                out = _send(mix64(tokens[early]), owner[early], rid, (task << 20) + turn, width, ranges)
                if out:
                    yield pa.RecordBatch.from_pylist(out, _SENT)
                turn, done = turn + 1, done + part.num_rows

    return _owned(map_arrow(docs, run, _SENT_SQL), ranges, grouped=False)


def _overlap_of_groups(sets: DataFrame) -> DataFrame:
    """(grp, shared): a bound for how many tokens of any member of a group
    other groups hold. ``sets``: (grp, tokens). Members that a batch holds are
    united; a document lies in one batch, so the largest count bounds it."""
    spark = sets.sparkSession
    total = int(sets.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0) // 8
    ranges, width = _ranges(spark, total), token_width(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "tokens"):
                flat, offsets = binary_view(part.column("tokens"))
                names, unit = np.unique(part.column("grp").to_numpy(), return_inverse=True)
                out = _send(mix64(flat.view(np.uint64)), np.repeat(unit, np.diff(offsets) // 8), names, (task << 20) + turn, width, ranges)
                if out:
                    yield pa.RecordBatch.from_pylist(out, _SENT)
                turn += 1

    per_batch = _summed(_owned(map_arrow(sets.select("grp", "tokens"), run, _SENT_SQL), ranges, grouped=True))
    return per_batch.groupBy(F.col("unit").alias("grp")).agg(F.max("shared").alias("shared"))


# --- full sets -------------------------------------------------------------


def _packed_texts(docs: DataFrame) -> DataFrame:
    """(id, key, z): texts compressed for the way to those that want them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = pa.array([packer.compress(t) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), z], ["id", "key", "z"])

    return map_arrow(docs.select("id", "key", "text"), run, "id bigint, key bigint, z binary")


def _sets(docs: DataFrame) -> DataFrame:
    """(rid, n, minhash, alone, tokens): the full sets, packed."""
    names = ["rid", "n", "minhash", "alone"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = pa.array([reader.decompress(z) for z in batch.column("z").to_pylist()], pa.binary())
            whole = pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), texts], [*names, "text"])
            for part in slices(whole, "text"):
                tokens, at = shingle_sets(part, "text")
                packed = pa.array([tokens[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], packed], [*names, "tokens"])

    return map_arrow(docs, run, "rid bigint, n bigint, minhash array<bigint>, alone bigint, tokens binary")


# --- groups ----------------------------------------------------------------


def _lead(rows: DataFrame, threshold: int) -> DataFrame:
    """Links found inside buckets. ``rows``: (bucket, rid, tokens), a bucket's
    rows side by side, those from the middle of a family first; each is
    compared with the bucket's first unlike ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leaders = None, []
        for batch in batches:
            a, b = [], []
            for bucket, rid, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != bucket:
                    now, leaders = bucket, []
                tokens = np.frombuffer(packed, np.uint64)
                alone = True
                for other, own in leaders:
                    if other != rid and linked(own, tokens, threshold):
                        a.append(other)
                        b.append(rid)
                        alone = False
                if alone and len(leaders) < LEADERS:
                    leaders.append((rid, tokens))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_arrow(rows.select("bucket", "rid", "tokens"), run, "a bigint, b bigint")


def _groups(sets: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(links, moved): verified links, and (rid, grp) of every set whose group
    has another name than itself."""
    links = moved = None
    for r in range(MINHASHES):
        bucket = F.col("minhash")[r].alias("bucket")
        if links is None:
            sizes = stored(sets.groupBy(bucket).agg(F.count("*").alias("size")).where("size > 1").select("bucket"), "join-buckets")
            rows = sets.select(bucket, "rid", F.col("alone").alias("order"), "tokens").join(sizes, "bucket")
        else:
            # One member per group and bucket stands for the others, the one that most are linked to.
            degree = links.groupBy(F.col("a").alias("rid")).agg((-F.count("*")).alias("order"))
            hashed = sets.select("rid", bucket).join(moved, "rid", "left").join(degree, "rid", "left").select("rid", "bucket", F.coalesce("grp", "rid").alias("grp"), F.coalesce("order", F.lit(0)).alias("order"))
            members = hashed.groupBy("bucket", "grp").agg(F.min(F.struct("order", "rid")).alias("best")).select("bucket", "grp", F.col("best.rid").alias("rid"), F.col("best.order").alias("order"))
            several = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
            placed = stored(members.join(several, "bucket").select("rid", "bucket", "order"), "join-placed")
            rows = sets.select("rid", "tokens").join(placed, "rid")
        dealt = rows.repartition(partitions(sets.sparkSession), "bucket").sortWithinPartitions("bucket", "order", "rid")
        new = stored(_lead(dealt, threshold), "join-links")
        links = new if links is None else stored(links.union(new), "join-links")
        found = connected_components(links)
        moved = stored(found.where("node <> component").select(F.col("node").alias("rid"), F.col("component").alias("grp")), "join-moved")
    return links, moved


# --- the token-group matrix ------------------------------------------------


def _matrix_rows(left: pa.Table, right: pa.Table, threshold: int) -> pa.Table:
    """Links of askers (left) with one block of a group's members (right). The
    block's token union bounds each asker's overlap first; only then are its
    columns, the members, opened."""
    rids, each = right.column("member").to_numpy(), [np.frombuffer(t, np.uint64) for t in right.column("held").to_pylist()]
    sizes = np.array([len(t) for t in each], np.int64)
    tokens = np.concatenate(each) if each else np.empty(0, np.uint64)
    member = np.repeat(np.arange(len(each)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, member = tokens[order], member[order]
    a, b = [], []
    if len(tokens):
        union, start = np.unique(tokens, return_index=True)
        stop = np.append(start[1:], len(tokens))
        for i, packed in zip(left.column("rid").to_pylist(), left.column("tokens").to_pylist(), strict=True):
            q = np.frombuffer(packed, np.uint64)
            at = np.searchsorted(union, q)
            at[at == len(union)] = 0
            at = at[union[at] == q]
            if 100 * len(at) < threshold * len(q):
                continue  # closed: no member can hold enough of it
            times = stop[at] - start[at]
            which = np.arange(times.sum()) + np.repeat(start[at] - (np.cumsum(times) - times), times)
            both = np.bincount(member[which], minlength=len(each))
            hit = np.flatnonzero(100 * both >= threshold * (sizes + len(q) - both))
            if len(hit):  # one link connects the whole group
                a.append(i)
                b.append(int(rids[hit[0]]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _open_groups(sets: DataFrame, threshold: int, members: int = 1) -> DataFrame:
    """Exact links of documents with other groups of at least ``members``
    documents. ``sets``: (rid, grp, n, tokens) of the groups that are open."""
    spark = sets.sparkSession

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "tokens"):
                flat, offsets = binary_view(part.column("tokens"))
                at = pa.array(np.repeat(np.arange(part.num_rows), np.diff(offsets) // 8))
                yield pa.RecordBatch.from_arrays([part.column(k).take(at) for k in range(3)] + [pa.array(flat.view(np.int64))], ["rid", "grp", "n", "token"])

    tokens = map_arrow(sets.select("rid", "grp", "n", "tokens"), unpack, "rid bigint, grp bigint, n bigint, token bigint")
    # Tokens that different groups hold, the rare ones first: one order for all documents.
    rarity = tokens.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high"), F.count("*").alias("df")).where("low < high").select("token", "df")
    shared = tokens.join(stored(rarity, "join-rarity"), "token")
    by_doc = Window.partitionBy("rid")
    enough = F.ceil(F.col("n") * threshold / 100).cast("long")
    ranked = shared.withColumn("k", F.count("*").over(by_doc)).withColumn("nth", F.row_number().over(by_doc.orderBy("df", "token")))
    # Similar documents share one of their first n - enough + 1 tokens, those of no other group being the very first.
    first = stored(ranked.where(F.col("nth") <= F.col("k") - enough + 1).select("rid", "grp", "n", "k", "token"), "join-first")
    # Similar sets a, b overlap in at least t / (100 + t) of |a| + |b| tokens, and in at most k of either: so
    # (100 + t) * k - t * n of the one must reach t times the other's size, both ways.
    room = F.col("k") * (100 + threshold) - F.col("n") * threshold
    sizes = stored(sets.groupBy("grp").agg(F.count("*").alias("members")), "join-sizes")
    first = first.join(sizes, "grp")
    larger = first if members == 1 else first.where(F.col("members") >= members)
    matrix = larger.groupBy("token", F.col("grp").alias("other"), F.col("members").alias("others")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(room).alias("most"))
    fits = (F.col("n") * 100 >= F.col("low") * threshold) & (F.col("high") * 100 >= F.col("n") * threshold)
    fits = fits & (room >= F.col("low") * threshold) & (F.col("most") >= F.col("n") * threshold)
    # Of two groups the smaller one asks: its few members meet the larger one's matrix.
    asks = F.struct("members", "grp") < F.struct("others", "other")
    maybe = first.join(matrix, "token").where(asks & fits).select("rid", "other", "others").distinct()
    asked = stored(maybe.select("rid", "other", F.ceil(F.col("others") / BLOCK).cast("int").alias("blocks")), "join-asked")
    # Members and askers of a group are both cut into blocks; every pair of blocks meets once.
    turns = stored(asked.groupBy("other").agg(F.max("blocks").alias("blocks"), F.ceil(F.count("*") / BLOCK).cast("int").alias("turns")), "join-turns")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = sets.select(F.col("grp").alias("other"), "rid", "tokens").join(turns, "other").withColumn("turn", every("turns"))
    held = held.select("other", F.pmod(F.xxhash64("rid"), "blocks").cast("int").alias("block"), "turn", F.col("rid").alias("member"), F.col("tokens").alias("held"))
    askers = asked.select("rid", "other").join(turns, "other").join(sets.select("rid", "tokens"), "rid").withColumn("block", every("blocks"))
    askers = askers.select("other", "block", F.pmod(F.xxhash64("rid"), "turns").cast("int").alias("turn"), "rid", "tokens")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        return _matrix_rows(left, right, threshold)

    ship(spark)
    keys = ["other", "block", "turn"]
    return askers.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(compare, "a bigint, b bigint")


def _components(docs: DataFrame, id_col: str, text_col: str, threshold: int) -> DataFrame:
    """(rid, id, key, n, component) of every row of ``docs``; ``component`` is
    the class representative that names the component, null for empty sets."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    size = source.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    passed = stored(_first_pass(source.select("id", "key", "text"), threshold, int(size) // 6), "join-rows")
    rows = passed.where("rid is not null").select("rid", "id", "key", "n", "fp1", "fp2", "minhash")
    counted = _summed(passed).withColumnRenamed("unit", "rid")
    classes = stored(
        rows.where("n > 0")
        .groupBy("fp1", "fp2")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid", "key")).alias("rep"))
        .select("fp1", "fp2", F.col("rep.rid").alias("rid"), F.col("rep.id").alias("id"), F.col("rep.key").alias("key")),
        "join-classes",
    )
    # Step 2: rows that share enough of their first tokens with any other row.
    live = rows.select("rid", "n", "minhash").join(counted, "rid").where(F.col("shared") >= F.greatest(F.lit(1), F.ceil(F.col("n") * threshold / 1000)))
    # How many of its first tokens a row holds alone: few in the middle of a family of near copies.
    first = F.col("n") - F.ceil(F.col("n") * threshold / 100) + F.greatest(F.lit(1), F.ceil(F.col("n") / 10))
    live = live.withColumn("alone", (first - F.col("shared")).cast("long"))
    # A class goes on if its representative is live; equal sets have equal counts.
    left = stored(classes.select("rid", F.col("id").alias("want"), F.col("key").alias("want_key")).join(live.select("rid", "n", "minhash", "alone"), "rid"), "join-live")
    texts = _packed_texts(source).join(left, (F.col("key") == F.col("want_key")) & F.col("id").eqNullSafe(F.col("want"))).select("rid", "n", "minhash", "alone", "z")
    sets = stored(_sets(texts), "join-sets")
    if sets.count() > left.count():  # rows repeated with id and text
        sets = stored(sets.dropDuplicates(["rid"]), "join-sets")
    links, moved = _groups(sets, threshold)
    open_ = sets.select("rid", "n", "tokens").join(moved, "rid", "left").select("rid", F.coalesce("grp", "rid").alias("grp"), "n", "tokens")
    # Step 4: groups that overlap all other groups too little are closed.
    bound = _overlap_of_groups(open_).join(open_.groupBy("grp").agg(F.min("n").alias("low")), "grp")
    still = bound.where(F.col("shared") * 100 >= F.col("low") * threshold).select("grp")
    open_ = stored(open_.join(still, "grp", "left_semi"), "join-open")
    # First the groups of several members, which most of the rest belong to; then all groups, of which few are left.
    links = stored(links.union(_open_groups(open_, threshold, members=2)), "join-links")
    found = connected_components(links).withColumnRenamed("node", "rid")
    regrouped = open_.drop("grp").join(found, "rid", "left").select("rid", F.coalesce("component", "rid").alias("grp"), "n", "tokens")
    across = stored(_open_groups(stored(regrouped, "join-open"), threshold), "join-across")
    found = connected_components(links.union(across)).withColumnRenamed("node", "rid")
    named = stored(classes.join(found, "rid", "left").select("fp1", "fp2", F.col("id").alias("own"), F.coalesce("component", "rid").alias("component")), "join-named")
    return rows.select("rid", "id", "key", "n", "fp1", "fp2").join(named, ["fp1", "fp2"], "left").drop("fp1", "fp2")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    rows = stored(_components(docs, id_col, text_col, threshold), "join-components")
    names = stored(rows.where("component is not null").groupBy("component").agg(F.min("own").alias("component_id")), "join-names")
    return rows.join(names, "component", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the row
    with the smallest id (null ids last), of rows repeated with one id that
    with the smallest text hash. Rows with an empty set stay."""
    rows = stored(_components(docs, id_col, text_col, threshold), "join-components").where("component is not null")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    kept = stored(rows.groupBy("component").agg(F.min(order).alias("best")), "join-kept")
    lost = stored(rows.join(kept, "component").where(order > F.col("best")).select(F.col("id").alias("__id"), F.col("key").alias("__key")).distinct(), "join-lost")
    return docs.join(lost, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text_of(text_col)) == F.col("__key")), "left_anti")
