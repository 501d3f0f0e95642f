"""Approximate nearest neighbours: a hierarchical k-means tree, searched best
bin first.

The tree is fitted on a bounded sample (``sample_rows`` rows, less for long
vectors; taken in the order of a hash of the id) and is all that is broadcast.
Every row is then routed to its leaf. A query walks the tree with a priority
queue of nodes by the distance to their centres and visits the nearest leaves.
How many is calibrated: for up to ``calibration`` queries the exact neighbours
are found among all rows, and the number of leaf visits is widened by a
quarter until at least ``recall`` of them lie in visited leaves (all leaves, in
the worst case). A query whose leaves hold too few different ids for ``k``
neighbours goes on to further leaves until they do.

Rows lie in blocks of a few thousand: small neighbouring leaves share one, a
large leaf is cut into several. A query is compared with the blocks that hold
its leaves, and the nearest ``k`` of each block go on; so a leaf that holds a
third of all rows (equal vectors cannot be split) is spread over many tasks.
The queries of a block are cut into turns likewise.

Distances are Euclidean, in double precision, on the original vectors.
Defined cases: vectors that are null, empty or zero, that hold null or
non-finite components, or whose length is not the most common one (ties: the
longer) take no part, nor do rows without an id; rows repeated with one id
count as one; fewer than ``k`` other rows are all returned; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, ship, stored

#: Rows, and queries, in a block.
BLOCK = 4096


# --- the tree --------------------------------------------------------------


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray | None:
    """Group numbers of a k-means split, or None if the points don't differ."""
    different = np.unique(x[rng.permutation(len(x))[: 64 * k]], axis=0)
    if len(different) < 2:
        different = np.unique(x, axis=0)
        if len(different) < 2:
            return None
    centres = different[rng.permutation(len(different))[:k]]
    group = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        group = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
        sizes = np.bincount(group, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, group, x)
        kept = sizes > 0
        centres = np.where(kept[:, None], sums / np.maximum(sizes, 1)[:, None], centres)
    used, group = np.unique(group, return_inverse=True)
    return group if len(used) > 1 else None


class Tree:
    """Nodes in breadth-first order: ``centre``, children [first, last), and
    the leaf number (-1 for inner nodes)."""

    def __init__(self, x: np.ndarray, branching: int, leaf_rows: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        centres, first, last, leaf = [x.mean(0)], [0], [0], [-1]
        queue = [(0, np.arange(len(x)))]
        leaves = 0
        for node, rows in queue:  # grows while it is read
            group = _kmeans(x[rows], branching, rng) if len(rows) > leaf_rows else None
            if group is None:
                leaf[node] = leaves
                leaves += 1
                continue
            first[node] = len(centres)
            for g in range(group.max() + 1):
                part = rows[group == g]
                centres.append(x[part].mean(0))
                first.append(0)
                last.append(0)
                leaf.append(-1)
                queue.append((len(centres) - 1, part))
            last[node] = len(centres)
        self.centre = np.array(centres)
        self.first, self.last, self.leaf = np.array(first), np.array(last), np.array(leaf)
        self.leaves = leaves

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: always to the nearest child."""
        out = np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            children = self.centre[self.first[node] : self.last[node]]
            nearest = np.argmin((children**2).sum(1) - 2 * x[rows] @ children.T, axis=1)
            order = np.argsort(nearest, kind="stable")
            cuts = np.searchsorted(nearest[order], np.arange(len(children) + 1))
            todo += [(self.first[node] + c, rows[order[a:b]]) for c, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        return out

    def visit(self, q: np.ndarray, most: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``most`` leaves, best bin first; with ``sizes`` of the
        leaves given, more until they sum up to ``least``."""
        queue: list[tuple[float, int]] = [(0.0, 0)]
        out: list[int] = []
        held = 0
        while queue and (len(out) < most or (sizes is not None and held < least)):
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(int(self.leaf[node]))
                held += 0 if sizes is None else int(sizes[out[-1]])
                continue
            a, b = self.first[node], self.last[node]
            for d, child in zip(((self.centre[a:b] - q) ** 2).sum(1).tolist(), range(a, b), strict=True):
                heapq.heappush(queue, (d, child))
        return out


# --- rows ------------------------------------------------------------------


def usable_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): rows with an id and a finite, non-zero vector of the usual length."""
    v = F.col("v")
    # An infinite or NaN component fails abs(x) < inf, a null one makes forall null.
    good = F.coalesce(F.forall(v, lambda x: F.abs(x) < float("inf")) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & good)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (usual.n if usual else 0))


def matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` to ``q``, summed in order of the components."""
    return np.sqrt(((x - q) ** 2).sum(1))


def nearest(ids: np.ndarray, x: np.ndarray, q_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest ids and their distances, ties to the smaller id."""
    d = distances(x, q)
    d[ids == q_id] = np.inf
    if len(d) > k:
        near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
    else:
        near = np.arange(len(d))
    near = near[np.lexsort((ids[near], d[near]))][:k]
    near = near[np.isfinite(d[near])]
    return ids[near], d[near]


_FOUND = "query_id bigint, vec_id bigint, score double"


def _found(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    ids = np.concatenate([np.full(len(i), q, np.int64) for q, i, _ in parts]) if parts else np.empty(0, np.int64)
    vec = np.concatenate([i for _, i, _ in parts]) if parts else np.empty(0, np.int64)
    d = np.concatenate([x for _, _, x in parts]) if parts else np.empty(0)
    return pa.table({"query_id": ids, "vec_id": vec, "score": d})


def _top(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def brute_force(rows: DataFrame, ids: np.ndarray, vectors: np.ndarray, k: int) -> DataFrame:
    """Exact neighbours of a few queries (broadcast) among all rows."""
    shared = rows.sparkSession.sparkContext.broadcast((ids, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, own = matrix(batch.column(1)), batch.column(0).to_numpy()
            own, at = np.unique(own, return_index=True)
            parts = [(int(i), *nearest(own, x[at], i, q, k)) for i, q in zip(*shared.value, strict=True)]
            yield from _found(parts).to_batches()

    return _top(map_arrow(rows, run, _FOUND), k)


def calibrate(tree: Tree, rows: DataFrame, queries: DataFrame, k: int, recall: float, calibration: int) -> tuple[int, float]:
    """(leaf visits, recall reached) on a few queries with known neighbours."""
    some = queries.orderBy(F.xxhash64("id"), "id").limit(calibration).collect()
    if not some:
        return 1, 1.0
    ids, vectors = np.array([r.id for r in some]), np.array([r.v for r in some])
    truth = brute_force(rows, ids, vectors, k).select("query_id", F.col("vec_id").alias("id")).dropDuplicates()
    leaf_of = _routed(rows.join(F.broadcast(truth), "id").select("query_id", "id", "v"), tree).select("query_id", "leaf").collect()  # at most calibration * k
    order = {int(i): {leaf: n for n, leaf in enumerate(tree.visit(q, tree.leaves))} for i, q in zip(ids, vectors, strict=True)}
    places = np.array([order[r.query_id][r.leaf] for r in leaf_of])
    visits = 1
    while visits < tree.leaves and len(places) and (places < visits).mean() < recall:
        visits = min(visits + 1 + visits // 4, tree.leaves)
    return visits, float((places < visits).mean()) if len(places) else 1.0


def _routed(rows: DataFrame, tree: Tree) -> DataFrame:
    """Rows (..., v) with their leaf."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.route(matrix(batch.column("v"))) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], [*names, "leaf"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return map_arrow(rows, run, f"{kinds}, leaf int")


def _visits(queries: DataFrame, tree: Tree, most: int, blocks: Blocks, ids: np.ndarray, k: int) -> DataFrame:
    """(id, v, block): the blocks of rows that hold a query's leaves; ``ids``:
    how many ids each leaf holds that no other leaf is counted for."""
    shared = queries.sparkSession.sparkContext.broadcast((tree, blocks, ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, at, sizes = shared.value
        for batch in batches:
            found = [np.unique(np.concatenate([np.arange(at.first[n], at.first[n] + at.parts[n]) for n in walk.visit(q, most, sizes, k + 1)])) for q in matrix(batch.column("v"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], ["id", "v", "blocks"])

    return map_arrow(queries, run, "id bigint, v array<double>, blocks array<bigint>").select("id", "v", F.explode("blocks").alias("block"))


class Blocks:
    """Where the rows of each leaf are: neighbouring leaves share a block while
    it has at most ``BLOCK`` rows, a larger leaf is cut into several."""

    def __init__(self, counts: dict[int, int], leaves: int):
        self.first, self.parts = np.zeros(leaves, np.int64), np.ones(leaves, np.int64)
        block, held = 0, 0
        for leaf in range(leaves):
            n = counts.get(leaf, 0)
            if held and held + n > BLOCK:
                block, held = block + 1, 0
            self.first[leaf] = block
            if n > BLOCK:
                self.parts[leaf] = -(-n // BLOCK)
                block, held = block + int(self.parts[leaf]), 0
            else:
                held += n


def _placed(index: DataFrame, blocks: Blocks) -> DataFrame:
    """(block, id, v) of every row."""
    shared = index.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            leaf, own = batch.column("leaf").to_numpy(), batch.column("hash").to_numpy()
            block = at.first[leaf] + own % at.parts[leaf]
            yield pa.RecordBatch.from_arrays([pa.array(block), batch.column("id"), batch.column("v")], ["block", "id", "v"])

    return map_arrow(index.withColumn("hash", F.xxhash64("id")), run, "block bigint, id bigint, v array<double>")


def ann_search(
    embeddings: DataFrame,
    *,
    is_query: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    recall: float = 0.95,
    calibration: int = 64,
    sample_rows: int = 65_536,
    branching: int = 8,
    leaf_rows: int = 256,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, a
    query being a row for which ``is_query`` (on ``id``) holds."""
    spark = embeddings.sparkSession
    is_query = F.col("id") % 100 == 0 if is_query is None else is_query
    rows = usable_vectors(embeddings, id_col, vector_col)
    first = rows.first()
    if first is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    bound = max(1024, min(sample_rows, (1 << 23) // len(first.v)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(bound).select("v").toArrow()
    tree = Tree(matrix(sample.column(0).combine_chunks()), branching, leaf_rows)
    index = stored(_routed(rows, tree), "ann-index")
    queries = stored(rows.where(is_query).dropDuplicates(["id"]), "ann-queries")
    visits, _ = calibrate(tree, rows, queries, k, recall, calibration)
    counts = {r.leaf: r.n for r in index.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # the tree bounds the leaves
    blocks = Blocks(counts, tree.leaves)
    ids = np.zeros(tree.leaves, np.int64)
    for r in index.groupBy("id").agg(F.min("leaf").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n")).collect():
        ids[r.leaf] = r.n
    asked = stored(_visits(queries, tree, visits, blocks, ids, k), "ann-visits")
    # A block that more than BLOCK queries visit is compared in several turns.
    turns = stored(asked.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("turns")), "ann-turns")
    askers = asked.join(turns, "block").select("block", F.pmod(F.xxhash64("id"), "turns").cast("int").alias("turn"), "id", "v")
    held = _placed(index, blocks).join(turns, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "id", "v")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found([])
        ids, at = np.unique(right.column("id").to_numpy(), return_index=True)
        x = matrix(right.column("v").combine_chunks())[at]
        asked_ids, vectors = left.column("id").to_numpy(), matrix(left.column("v").combine_chunks())
        return _found([(int(i), *nearest(ids, x, i, q, k)) for i, q in zip(asked_ids, vectors, strict=True)])

    ship(spark)
    pairs = askers.groupBy("block", "turn").cogroup(held.groupBy("block", "turn"))
    return _top(pairs.applyInArrow(compare, _FOUND), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
