"""Conversation prefix trie by whole-sequence collapse.

The trie is never built node by node. Identical conversations are first
collapsed to one weighted sequence with the list of those that end there; a
sequence that is a proper prefix of another (found by an anti-join against the
prefixes) is no leaf; and what a node says is a sum over the weighted sequences
that begin with it, taken prefix by prefix.

A sequence of turns is known by its length and by the sum, over its turns, of a
digest of (place, role, text): four lanes of 32 bits of a SHA-256, 128 bits
together. A sum needs no order of work: whole conversations are summed with a
map-side combine, prefixes by running sums within steps of ``STEP`` turns and
over the steps' totals, so that a conversation holding a third of all turns is
spread like any other rows. A prefix's parent is its own sum less its last turn.

Bytes saved below a node: members count the bytes from the node's last turn to
their end, distinct nodes count once. Nodes with one smallest member form a tail
of that member's sequence, so a sequence knows from which byte on it counts
alone, and both sums go prefix by prefix too.

Lists of ends are joined in pieces of ``PIECE`` ids by many tasks; only the
pieces of one node, not its rows, are hashed one after the other.

Defined cases: rows with a null conv_id belong to no conversation and are left
out; turns come in the order of turn, null first, equal ones by the digest of
role and text; null role and text count as empty; repeated rows are turns of
their own; texts of any length count whole; other columns are ignored, whatever
their names; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, partitions, stored
from .ranks import places, spread

#: Turns of one conversation that one running sum covers; ids in one piece of a list.
STEP, PIECE = 4096, 4096
LANES = ("p1", "p2", "p3", "p4")
NODE = ("depth", *LANES)
EMPTY = hashlib.sha256(b"").hexdigest()


def _lanes(depth: Column, said: Column) -> list[Column]:
    """The four lanes of a turn's digest at its place."""
    digest = F.sha2(F.concat(depth.cast("string"), F.lit(":"), F.hex(said)).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"x{i + 1}") for i in range(4)]


def rebuilt_turns(convs: DataFrame, group: int = 5, shared: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of the rebuilt conversations. A conversation c starts
    with the first h turns of conversation c - c % ``group``, h being the
    CRC-32 of c modulo ``shared``; its own turns after its first h follow.
    turns: (c, depth from 1, bytes, x1 .. x4); lengths: (c, length)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    said = F.concat(F.octet_length(text("role")).cast("string"), F.lit(":"), text("role"), text("text"))
    rows = stored(
        convs.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("c"), F.col("turn"), F.unhex(F.sha2(said.cast("binary"), 256)).alias("said"), F.octet_length(text("text")).cast("long").alias("bytes")
        ),
        "trie-said",
    )
    placed, spans = spread(rows, rows.count(), "c", ["turn", "said"], "trie-turns")
    # One row per task and conversation meets what the conversation needs to know.
    sizes = spans.groupBy("c").agg(F.max("n").alias("n")).withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % shared).withColumn("host", F.col("c") - F.col("c") % group)
    hosts = sizes.select(F.col("c").alias("host"), F.col("n").alias("host_n"))
    taken = sizes.join(hosts, "host", "left").withColumn("taken", F.least("h", F.coalesce("host_n", F.lit(0))))
    taken = stored(taken.select("c", "host", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-lengths")
    turns = stored(places(placed, spans.join(taken.select("c", "h", "taken"), "c"), "c"), "trie-places")
    own = turns.where("pos >= h").select("c", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "said", "bytes")
    # At most shared - 1 turns of a host meet at most ``group`` conversations.
    first = turns.where((F.col("pos") < shared - 1) & (F.col("c") % group == 0)).select(F.col("c").alias("host"), "pos", "said", "bytes")
    lent = taken.select("c", "host", "taken").join(first, "host").where("pos < taken").select("c", (F.col("pos") + 1).alias("depth"), "said", "bytes")
    every = own.unionByName(lent)
    return stored(every.select("c", "depth", "bytes", *_lanes(F.col("depth"), F.col("said"))), "trie-rebuilt"), taken.select("c", "length")


def sequences(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ends, collapsed). ends: (c, depth, p1 .. p4, total) of every
    conversation, depth being its length and total its bytes; collapsed: the
    different ones, with c the smallest and weight the number of conversations."""
    whole = turns.groupBy("c").agg(*[F.sum(f"x{i}").alias(f"p{i}") for i in range(1, 5)], F.sum("bytes").alias("total"))
    ends = lengths.select("c", F.col("length").alias("depth")).join(whole, "c", "left").fillna(0, [*LANES, "total"])
    ends = stored(ends.select("c", *NODE, "total"), "trie-ends")
    return ends, stored(ends.groupBy(*NODE).agg(F.min("c").alias("c"), F.count("*").alias("weight"), F.max("total").alias("total")), "trie-sequences")


def end_lists(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(node, ends_sha256): the digest of the ids that end at a node, in
    ascending order, joined by commas."""
    keyed = stored(ends.select(F.concat_ws("-", *NODE).alias("seq"), *NODE, "c"), "trie-keyed")
    placed, spans = spread(keyed, keyed.count(), "seq", ["c"], "trie-keyed-places")
    listed = places(placed, spans, "seq").withColumn("part", F.expr(f"pos div {piece}"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",")  # at most ``piece`` of them
    parts = stored(listed.groupBy("seq", "part", *NODE).agg(F.max("n").alias("n"), ids.alias("ids")), "trie-parts")
    short = parts.where(F.col("n") <= piece).select(*NODE, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, node, digest = None, None, None
        for batch in batches:
            for seq, ids, *at in zip(*(batch.column(c).to_pylist() for c in ("seq", "ids", *NODE)), strict=True):
                if seq != now:
                    if now is not None:
                        yield _one(node, digest)
                    now, node, digest = seq, at, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if now is not None:
            yield _one(node, digest)

    long = parts.where(F.col("n") > piece).repartition(partitions(ends.sparkSession), "seq").sortWithinPartitions("seq", "part")
    return short.unionByName(map_arrow(long, run, ", ".join(f"{c} bigint" for c in NODE) + ", ends_sha256 string"))


def _one(node: list[int], digest) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in node), pa.array([digest.hexdigest()], pa.string())], [*NODE, "ends_sha256"])


def _stepped(rows: DataFrame, length: str, step: int) -> DataFrame:
    """One row for each step of a sequence (one for an empty sequence)."""
    last = F.expr(f"greatest({length} - 1, 0) div {step}")
    return rows.withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))


def prefixes(turns: DataFrame, collapsed: DataFrame, step: int = STEP) -> DataFrame:
    """Every prefix of every collapsed sequence: (c, step, depth, p1 .. p4,
    q1 .. q4 its parent's, bytes of its last turn, upto: bytes so far, and of
    the sequence weight, length, total)."""
    of = collapsed.select("c", "weight", F.col("depth").alias("length"), "total")
    kept = turns.withColumn("step", F.expr(f"(depth - 1) div {step}")).join(_stepped(of, "length", step), ["c", "step"])
    sums = {**{f"x{i}": f"p{i}" for i in range(1, 5)}, "bytes": "upto"}
    running = Window.partitionBy("c", "step").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)  # at most ``step`` rows
    earlier = Window.partitionBy("c").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)  # one row per step
    totals = kept.groupBy("c", "step").agg(*[F.sum(x).alias(f"s_{x}") for x in sums])
    base = totals.select("c", "step", *[F.coalesce(F.sum(f"s_{x}").over(earlier), F.lit(0)).alias(f"b_{x}") for x in sums])
    within = kept.select("*", *[F.sum(x).over(running).alias(f"r_{x}") for x in sums]).join(base, ["c", "step"])
    row = within.select("c", "step", "depth", "bytes", "weight", "length", "total", *[f"x{i}" for i in range(1, 5)], *[(F.col(f"r_{x}") + F.col(f"b_{x}")).alias(name) for x, name in sums.items()])
    row = row.select("c", "step", *NODE, *[(F.col(f"p{i}") - F.col(f"x{i}")).alias(f"q{i}") for i in range(1, 5)], "bytes", "upto", "weight", "length", "total")
    zero = F.lit(0).cast("bigint")
    root = of.select("c", zero.alias("step"), *[zero.alias(n) for n in NODE], *[F.lit(None).cast("bigint").alias(f"q{i}") for i in range(1, 5)], zero.alias("bytes"), zero.alias("upto"), "weight", "length", "total")
    return stored(row.unionByName(root), "trie-prefixes")


def leaves(paths: DataFrame, collapsed: DataFrame) -> DataFrame:
    """(c) of the collapsed sequences that are no proper prefix of another."""
    proper = paths.where("depth < length").select(*NODE).distinct()
    return collapsed.join(proper, list(NODE), "left_anti").select("c")


def prefix_trie(convs: DataFrame, group: int = 5, shared: int = 9, step: int = STEP, piece: int = PIECE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    turns, lengths = rebuilt_turns(convs, group, shared)
    ends, collapsed = sequences(turns, lengths)
    paths = prefixes(turns, collapsed, step)
    parent = [f"q{i}" for i in range(1, 5)]
    nodes = stored(
        paths.groupBy(*NODE).agg(F.min("c").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("upto").alias("upto"), *[F.max(q).alias(q) for q in parent]),
        "trie-nodes",
    )
    # A sequence is the smallest member of a tail of its nodes: its own bytes start there.
    alone = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.min(F.col("upto") - F.col("bytes")).alias("alone"))
    of = collapsed.join(alone, "c", "left").join(leaves(paths, collapsed).withColumn("leaf", F.lit(1)), "c", "left")
    of = of.select("c", F.col("depth").alias("length"), F.coalesce("alone", "total").alias("alone"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    before = F.col("upto") - F.col("bytes")
    summed = (
        paths.join(_stepped(of, "length", step).drop("length"), ["c", "step"])
        .groupBy(*NODE)
        .agg(
            F.sum("leaf").cast("bigint").alias("n_leaves"),
            (F.sum(F.col("weight") * (F.col("total") - before)) - F.sum(F.col("total") - F.greatest("alone", before))).alias("saved_tokens"),
        )
    )
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(f"q{i}").alias(f"p{i}") for i in range(1, 5)]).agg(F.count("*").alias("n_children"))
    known = nodes.join(summed, list(NODE)).join(children, list(NODE), "left").join(end_lists(ends, piece), list(NODE), "left")
    known = stored(known.select(*NODE, *parent, "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")), "trie-known")
    # The root is every first turn's parent: one value. Deeper nodes meet their
    # parents in a plain join of stored tables, which Spark splits where one
    # parent has very many children.
    root = known.where("depth = 0").select("conv_id").first()
    over = known.select((F.col("depth") + 1).alias("depth"), *[F.col(f"p{i}").alias(f"q{i}") for i in range(1, 5)], F.col("conv_id").alias("above"))
    deeper = known.where("depth > 1").join(over.where("depth > 1"), ["depth", *parent])
    top = known.where("depth <= 1").withColumn("above", F.when(F.col("depth") == 1, F.lit(root[0] if root else None).cast("bigint")))
    out = ["conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return deeper.select(*out).union(top.select(*out))
