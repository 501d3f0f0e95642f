"""Merkle dataset manifest: incremental witnesses over aligned appends.

Every row is a leaf; the leaves of a part (a source) form one tree, the parts'
roots another, on top. Nodes are appended in order to a frontier of open
subtrees. A node that is appended gets an empty witness, attached to the open
subtree it is in; whenever a run of siblings is complete, the witnesses below
each of them are extended by the others, and the run becomes a node one level
higher. A witness thus grows with the sequence and is whole in the end.

Spark spreads the appends: a part is cut into aligned blocks of
``ARITY ** HEIGHT`` leaves, each block is one frontier, and the roots of the
blocks are appended in the same way, block after block, until a part has one
node. Witnesses are then put together downwards: a block's own part, then that
of its root. A part of any size is spread over its blocks, and no step holds
more than one block.

Defined cases: a null field counts as ``-``; null ids come first in a part, the
null part first among parts; rows repeated with one id follow in the order of
their leaves; an empty table has no rows; other columns are ignored, whatever
their names. Texts of any length are hashed inside the JVM, where only their
digests leave the row; a text is never cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored
from .ranks import places, spread, tasks_for

#: Siblings in a full run; levels of a block, which has ARITY ** HEIGHT leaves.
ARITY, HEIGHT = 3, 6
#: Rows that a task hands on together; rows of blocks that one task appends.
OUT_ROWS, BLOCK_ROWS = 4096, 1 << 18
#: The fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def run_digest(nodes: Sequence[bytes]) -> bytes:
    """The node above a run of siblings: digests are joined as hex text."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def levels(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    up = 0
    while n > 1:
        n, up = -(-n // ARITY), up + 1
    return up


class Frontier:
    """The open subtrees of a sequence that is being appended to."""

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, int, int]]] = []
        self.witnesses: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._add(0, (digest, at, at + 1))

    def _add(self, height: int, node: tuple[bytes, int, int]) -> None:
        if height == len(self.open):
            self.open.append([])
        self.open[height].append(node)
        if len(self.open[height]) == ARITY:
            self._complete(height)

    def _complete(self, height: int) -> None:
        """The run at ``height`` gets no further sibling."""
        run, self.open[height] = self.open[height], []
        for i, (_, first, last) in enumerate(run):
            others = b"".join(d for j, (d, _, _) in enumerate(run) if j != i)
            if others:
                for leaf in range(first, last):
                    self.witnesses[leaf].append(others)
        self._add(height + 1, (run_digest([d for d, _, _ in run]), run[0][1], run[-1][2]))

    def close(self, height: int) -> bytes:
        """The one node left at ``height``, to which shorter subtrees are raised."""
        for low in range(height):
            if low < len(self.open) and self.open[low]:
                self._complete(low)
        return self.open[height][0][0]


def fold(digest: bytes, place: int, n: int, witness: bytes, at: int = 0) -> tuple[bytes, int]:
    """The root that ``digest`` at ``place`` of ``n`` nodes leads to with the
    siblings of ``witness`` from byte ``at``; and the byte where they end."""
    while n > 1:
        i = place % ARITY
        others = min(ARITY, n - (place - i)) - 1
        left, right, after = at, at + 32 * i, at + 32 * others
        digest = run_digest([witness[left:right], digest, witness[right:after]])
        place, n, at = place // ARITY, -(-n // ARITY), after
    return digest, at


def _append(nodes: DataFrame, rows: int, height: int) -> DataFrame:
    """``nodes`` (k, pos, n, digest, more; ``rows`` of them) with ``witness``,
    the siblings within the block, and ``top``, the block's root."""
    block_size = ARITY**height
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + ", witness binary, top binary"
    names = [*nodes.columns, "witness", "top"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        witnesses: list[bytes] = []
        tops: list[bytes] = []
        now, size, frontier = None, 0, Frontier()

        def end() -> None:
            top = frontier.close(height if size > block_size else levels(size))
            tops.extend([top] * len(frontier.witnesses))
            witnesses.extend(b"".join(w) for w in frontier.witnesses)

        def out() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(witnesses, pa.binary()), pa.array(tops, pa.binary())], names)

        for batch in batches:
            blocks = [p // block_size for p in batch.column("pos").to_pylist()]
            start = 0
            for i, (k, block, n, digest) in enumerate(zip(batch.column("k").to_pylist(), blocks, batch.column("n").to_pylist(), batch.column("digest").to_pylist(), strict=True)):
                if (k, block) != now:
                    if now is not None:
                        end()
                        if len(tops) >= OUT_ROWS:
                            held.append(batch.slice(start, i - start))
                            yield out()
                            held, witnesses, tops, start = [], [], [], i
                    now, size, frontier = (k, block), n, Frontier()
                frontier.append(digest)
            if batch.num_rows > start:
                held.append(batch.slice(start))
        if now is not None:
            end()
            yield out()

    # Ranges of (part, block): a block is never cut, a part is.
    dealt = nodes.withColumn("__block", F.expr(f"pos div {block_size}"))
    dealt = dealt.repartitionByRange(tasks_for(nodes.sparkSession, rows, BLOCK_ROWS), "k", "__block").sortWithinPartitions("k", "pos").drop("__block")
    return map_arrow(dealt, run, kinds)


def _grown(nodes: DataFrame, rows: int, height: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The appended tables, leaves first, then roots of blocks, of blocks of
    those and so on; and (k, digest, level): every part's root and where it is."""
    tables: list[DataFrame] = []
    roots: DataFrame | None = None
    block = ARITY**height
    while True:
        made = stored(_append(nodes, rows, height), name)
        ended = made.where((F.col("pos") == 0) & (F.col("n") <= block)).select("k", F.col("top").alias("digest"), F.lit(len(tables)).alias("level"))
        roots = ended if roots is None else roots.union(ended)
        tables.append(made)
        if (made.agg(F.max("n")).first()[0] or 0) <= block:
            return tables, roots
        heads = made.where((F.col("pos") % block == 0) & (F.col("n") > block))
        nodes = stored(heads.select("k", F.expr(f"pos div {block}").alias("pos"), F.expr(f"(n + {block - 1}) div {block}").alias("n"), F.col("top").alias("digest")), f"{name}-blocks")
        rows = nodes.count()


def _whole(tables: list[DataFrame], ends: DataFrame, more: list[str], height: int) -> DataFrame:
    """The first table with whole witnesses. ``ends``: (k, level, up, more) of
    every part, ``up`` being what its root's witness adds. A block's rows meet
    one row, so a part of any size is no hot key."""
    above: DataFrame | None = None
    for level in range(len(tables) - 1, -1, -1):
        over = ends.where(F.col("level") == level).select("k", F.lit(0).cast("bigint").alias("block"), "up", *more)
        if above is not None:
            over = over.union(above.select("k", F.col("pos").alias("block"), F.col("witness").alias("up"), *more))
        made = tables[level].withColumn("block", F.expr(f"pos div {ARITY**height}"))
        joined = made.join(over, ["k", "block"])
        above = joined.withColumn("witness", F.concat("witness", "up")).drop("block", "up", "top")
        if level:
            above = stored(above, "merkle-down")
    return above


def leaf(columns: Sequence[Column]) -> Column:
    """The digest of a row: of every field its UTF-8 byte count, ``:`` and its
    value, or ``-``."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", part_col: str = "source", fields: Sequence[str] = FIELDS, claimed: Callable[[DataFrame], Column] | None = None, height: int = HEIGHT) -> tuple[DataFrame, bytes | None]:
    """The manifest of ``docs`` and its root (None without rows). Per row: id,
    digest (its leaf), pos and n (its place in its part and the part's leaves),
    part_pos and parts (likewise of the part), subroot, witness (the siblings on
    the way to the root, 32 bytes each); with ``claimed``, a digest computed
    from the row, that too."""
    own = leaf([F.col(f"`{c}`") for c in fields])
    part = F.col(f"`{part_col}`").cast("string")
    picked = docs.select(
        F.when(part.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), part)).alias("k"),  # null first, then bytewise
        F.col(f"`{id_col}`").alias("id"),
        own.alias("digest"),
        (F.lit(None).cast("binary") if claimed is None else claimed(docs)).alias("claimed"),
    )
    leaves = stored(picked.withColumn("claimed", F.coalesce("claimed", "digest")), "merkle-leaves")
    rows = leaves.count()
    placed, spans = spread(leaves, rows, "k", ["id", "digest"], "merkle-ordered")
    tables, roots = _grown(places(placed, spans, "k"), rows, height, "merkle")
    roots = stored(roots.select(F.lit("").alias("g"), "k", "digest", "level"), "merkle-parts")
    count = roots.count()
    placed, spans = spread(roots, count, "g", ["k"], "merkle-parts-ordered")
    parts = places(placed, spans, "g").select(F.col("g").alias("k"), "pos", "n", "digest", F.col("k").alias("part"), "level")
    above, top = _grown(parts, count, height, "merkle-top")
    found = top.first()  # one part of parts, one root
    ends = _whole(above, top.select("k", "level", F.lit(b"").alias("up")), [], height)
    ends = stored(ends.select(F.col("part").alias("k"), "level", F.col("witness").alias("up"), F.col("pos").alias("part_pos"), F.col("n").alias("parts"), F.col("digest").alias("subroot")), "merkle-ends")
    return _whole(tables, ends, ["part_pos", "parts", "subroot"], height).drop("k"), bytes(found["digest"]) if found else None


def verified(rows: DataFrame, root: bytes | None) -> DataFrame:
    """``rows`` of a manifest with proof_sha256 (of the witness as hex text),
    folded (the root that the claimed digest leads to) and verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proofs, folded = [], []
            for claim, place, n, part, parts, witness in zip(*(batch.column(c).to_pylist() for c in ("claimed", "pos", "n", "part_pos", "parts", "witness")), strict=True):
                proofs.append(hashlib.sha256(witness.hex().encode()).hexdigest())
                digest, at = fold(claim, place, n, witness)
                folded.append(fold(digest, part, parts, witness, at)[0])
            kept = [c for c in batch.schema.names if c not in ("claimed", "witness")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(proofs, pa.string()), pa.array(folded, pa.binary()), pa.array([f == root for f in folded], pa.bool_())],
                [*kept, "proof_sha256", "folded", "verified"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("claimed", "witness"))
    return map_arrow(rows, run, f"{kept}, proof_sha256 string, folded binary, verified boolean")


def _tampered(docs: DataFrame) -> Column:
    """The leaf of every second document (by the CRC-32 of its id) without the
    line feeds of its text."""
    text = F.col("text").cast("string")
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains(text, F.lit("\n"))
    return F.when(chosen, leaf([F.translate(text, "\n", "") if c == "text" else F.col(c) for c in FIELDS]))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of
    every document; half of them are checked with a tampered text."""
    rows, root = manifest(docs, claimed=_tampered)
    text = lambda c: F.lower(F.hex(c))
    return verified(rows, root).select(
        F.col("id").alias("doc_id"),
        text("digest").alias("leaf"),
        text("subroot").alias("subroot"),
        F.lit(root.hex() if root else None).cast("string").alias("root"),
        "proof_sha256",
        text("folded").alias("folded_root"),
        "verified",
    )
