"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words and their beginnings of 4, 6 and 8 bytes (slurs
are often inflected), each together with whether it occurs at least once,
twice, three and five times, and the magnitude of the text's word count; all
as 64-bit hashes. The model is
``w0 + sum(w_i) + 1/2 * sum_f((sum v_if)^2 - sum(v_if^2))`` through a logistic
function, so that a pair of terms (an insult with a group mention) can weigh
more, or less, than its parts.

Learning uses at most ``max_train`` labelled rows (a documented bound, taken
in the order of a hash of doc_id) and at most ``max_terms`` terms, those whose
presence says most about the label (G-test). ``trainers`` tasks each learn on
their own rows from the shared parameters, which are then averaged, for
``rounds`` rounds; the parameters, bounded by ``max_terms``, are all that
reaches the driver. Scoring is a map over all rows and whole texts.

Defined cases: a null or empty text has no terms and gets the model's prior;
labels that are null or of unknown documents are not used; without any
labelled training row every score is 0; with one class only, the score is that
class's smoothed share. Repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORDS, binary_view, blank_table, lowered, map_arrow, mix64, ship, slices, span_hashes, stored, text_of, word_hashes

_BLANK = blank_table(WORDS)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # sorted term hashes
    w0: float
    w: np.ndarray
    v: np.ndarray  # terms x factors

    def scores(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of ``n`` texts; (rows, terms): distinct pairs of row and term index."""
        z = np.full(n, self.w0) + np.bincount(rows, self.w[terms], n)
        for f in range(self.v.shape[1]):
            x = self.v[terms, f]
            z += 0.5 * (np.bincount(rows, x, n) ** 2 - np.bincount(rows, x * x, n))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


#: A term's features say that it occurs at least so often.
_TIMES = (1, 2, 3, 5)
#: Word beginnings that are terms too, in bytes.
_PREFIXES = (4, 6, 8)


def _terms(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash): the distinct features of each row, by row."""
    flat, offsets = binary_view(batch.column(column))
    low = lowered(flat)
    words, first, starts, stops = word_hashes(low, offsets, _BLANK, places=True)
    rows = np.repeat(np.arange(batch.num_rows), np.diff(first))
    all_rows, all_terms = [rows], [words]
    for length in _PREFIXES:
        longer = stops - starts > length
        at = starts[longer]
        all_rows.append(rows[longer])
        all_terms.append(span_hashes(low, at, at + length))
    rows, terms = np.concatenate(all_rows), np.concatenate(all_terms)
    order = np.lexsort((terms, rows))
    rows, terms = rows[order], terms[order]
    if len(rows):
        new = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1]))))
        times = np.diff(np.append(new, len(rows)))
        rows, terms = rows[new], terms[new]
    else:
        times = np.empty(0, np.int64)
    sizes = np.diff(first)
    magnitude = np.floor(np.log2(sizes + 1)).astype(np.uint64)
    out_rows, out_terms = [np.arange(batch.num_rows)], [mix64(magnitude + np.uint64(977))]
    for k, least in enumerate(_TIMES):
        often = times >= least
        out_rows.append(rows[often])
        out_terms.append(mix64(terms[often] + np.uint64(k)))
    rows = np.concatenate(out_rows)
    order = np.argsort(rows, kind="stable")
    return rows[order], np.concatenate(out_terms)[order]


def _features(docs: DataFrame) -> DataFrame:
    """(y, terms): the distinct term hashes of each labelled row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                rows, hashes = _terms(part, "__text")
                lists = [x.view(np.int64) for x in np.split(hashes, np.flatnonzero(np.diff(rows)) + 1)]
                by_row = dict(zip(np.unique(rows).tolist(), lists, strict=True))
                terms = pa.array([by_row.get(i, np.empty(0, np.int64)) for i in range(part.num_rows)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("__y"), part.column("__order"), terms], ["y", "shard", "terms"])

    return map_arrow(docs, run, "y int, shard bigint, terms array<bigint>")


def _g_test(df_pos: Column, df_neg: Column, pos: int, neg: int) -> Column:
    """Twice the information that a term's presence gives about the label."""
    n = pos + neg

    def part(observed: Column, row: Column, column: int) -> Column:
        return F.when(observed > 0, observed * F.log(observed * F.lit(float(n)) / (row * F.lit(float(column))))).otherwise(F.lit(0.0))

    df = df_pos + df_neg
    rest = F.lit(float(n)) - df
    return 2 * (part(df_pos, df, pos) + part(df_neg, df, neg) + part(F.lit(float(pos)) - df_pos, rest, pos) + part(F.lit(float(neg)) - df_neg, rest, neg))


def _learn(x: list[np.ndarray], y: np.ndarray, model: Model, epochs: int, rate: float, l2: float, positive: float, seed: int) -> tuple:
    """Adagrad over the rows of one trainer, from the shared parameters."""
    w0, w, v = model.w0, model.w.copy(), model.v.copy()
    g0, gw, gv = 1.0, np.ones_like(w), np.ones_like(v)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            at = x[i]
            vi = v[at]
            s = vi.sum(0)
            z = w0 + w[at].sum() + 0.5 * float((s * s).sum() - (vi * vi).sum())
            d = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, z)))) - y[i]
            if y[i]:
                d *= positive
            g0 += d * d
            w0 -= rate * d / math.sqrt(g0)
            dw = d + l2 * w[at]
            gw[at] += dw * dw
            w[at] -= rate * dw / np.sqrt(gw[at])
            dv = d * (s - vi) + l2 * vi
            gv[at] += dv * dv
            v[at] -= rate * dv / np.sqrt(gv[at])
    return w0, w, v


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_train: int = 20_000,
    max_terms: int = 3_000,
    min_rows: int = 5,
    min_information: float = 15.0,
    factors: int = 6,
    trainers: int = 6,
    rounds: int = 4,
    epochs: int = 4,
    rate: float = 0.15,
    l2: float = 1e-3,
) -> Model:
    """Learn the model from the labelled rows that are not held out."""
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("__y"))
        .withColumn("__order", F.xxhash64("__id"))
    )
    # The smallest hashes: no task need send more than about its share of twice as many rows.
    share = min(1.0, 2.0 * max_train / max(1, chosen.count()))
    chosen = (
        chosen.where(F.col("__order") <= int(min(2**63 - 1, share * 2.0**64 - 2.0**63)))
        .orderBy("__order", "__id")
        .limit(max_train)
    )
    # At most max_train rows of three numbers: a proven bound for the broadcast.
    rows = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text")).join(F.broadcast(chosen), "__id")
    train = stored(_features(rows.select("__y", "__order", "__text")), "toxicity-train")
    pos, neg = train.agg(F.sum(F.col("y")), F.sum(1 - F.col("y"))).first()
    pos, neg = int(pos or 0), int(neg or 0)
    empty = np.empty(0)
    if not pos or not neg:
        prior = -35.0 if not pos else math.log((pos + 1) / 1)
        return Model(np.empty(0, np.int64), prior, empty, np.empty((0, factors)))
    by_term = train.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").cast("double").alias("p"), F.sum(1 - F.col("y")).cast("double").alias("n"))
    best = (
        by_term.where(F.col("p") + F.col("n") >= min_rows).withColumn("g", _g_test(F.col("p"), F.col("n"), pos, neg)).where(F.col("g") >= min_information).orderBy(F.desc("g"), "term").limit(max_terms).select("term").collect()
    )
    keys = np.sort(np.array([r[0] for r in best], np.int64))
    k = len(keys)
    rng = np.random.default_rng(11)
    model = Model(keys, math.log(pos / neg), np.zeros(k), rng.normal(0, 0.02, (k, factors)))
    positive = min(8.0, max(1.0, neg / pos))  # both classes weigh alike, within reason
    shards = stored(_columns(train, keys).withColumn("trainer", F.pmod("shard", F.lit(trainers))), "toxicity-shards")
    for turn in range(rounds):
        parts = _round(shards, model, epochs, rate, l2, positive, turn)
        total = sum(p[0] for p in parts)
        mean = [sum(p[0] * p[i] for p in parts) / total for i in (1, 2, 3)]
        model = Model(keys, float(mean[0]), mean[1], mean[2])
    return model


def _columns(train: DataFrame, keys: np.ndarray) -> DataFrame:
    """The rows with the packed places of their terms among ``keys``: all that
    trainers need, and a small part of the terms."""
    shared = train.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            packed = []
            for terms in batch.column("terms"):
                t = terms.values.to_numpy(zero_copy_only=False) if len(terms) else np.empty(0, np.int64)
                at = np.searchsorted(known, t)
                at[at == len(known)] = 0
                packed.append((at[known[at] == t] if len(known) else at[:0]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("shard"), pa.array(packed, pa.binary())], ["y", "shard", "at"])

    return map_arrow(train, run, "y int, shard bigint, at binary")


def _round(shards: DataFrame, model: Model, epochs: int, rate: float, l2: float, positive: float, turn: int) -> list[tuple]:
    """Each trainer's (rows, w0, w, v) after learning on its rows. Who learns
    what, and in which order, hangs on the ids alone, never on file splits."""
    shared = shards.sparkSession.sparkContext.broadcast(model)

    def learn(rows: pa.Table) -> pa.Table:
        held = sorted(zip(rows["shard"].to_pylist(), rows["y"].to_pylist(), rows["at"].to_pylist(), strict=True))
        x = [np.frombuffer(at, "<i4") for _, _, at in held]
        y = np.array([label for _, label, _ in held], np.float64)
        w0, w, v = _learn(x, y, shared.value, epochs, rate, l2, positive, turn)
        out = {"trainer": [rows["trainer"][0].as_py()], "n": [len(x)], "w0": [float(w0)], "w": [w.astype("<f8").tobytes()], "v": [v.astype("<f8").tobytes()]}
        return pa.Table.from_pydict(out)

    ship(shards.sparkSession)
    got = shards.groupBy("trainer").applyInArrow(learn, "trainer bigint, n bigint, w0 double, w binary, v binary").collect()
    return [(r.n, r.w0, np.frombuffer(r.w, "<f8"), np.frombuffer(r.v, "<f8").reshape(model.v.shape)) for r in sorted(got)]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "__text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_score(m, part))], [id_col, "score"])

    picked = docs.select(id_col, text_of(text_col).alias("__text"))
    return map_arrow(picked, run, f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, score double")


def _score(m: Model, part: pa.RecordBatch, column: str = "__text") -> np.ndarray:
    rows, hashes = _terms(part, column)
    terms = hashes.view(np.int64)
    if len(m.keys) and len(terms):
        at = np.searchsorted(m.keys, terms)
        at[at == len(m.keys)] = 0
        hit = m.keys[at] == terms
        pairs = np.unique(rows[hit] * np.int64(len(m.keys)) + at[hit])
        return m.scores(pairs // len(m.keys), pairs % len(m.keys), part.num_rows)
    none = np.empty(0, np.int64)
    return m.scores(none, none, part.num_rows) if len(m.keys) else np.full(part.num_rows, 1.0 / (1.0 + math.exp(-m.w0)) if m.w0 > -35 else 0.0)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that the model, learned from them and ``labels``,
    does not call toxic; all columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **settings)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    text = "__text"
    while text in names:
        text += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                kept = part.filter(pa.array(_score(shared.value, part, text) < 0.5))
                yield pa.RecordBatch.from_arrays(kept.columns[: len(names)], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_arrow(docs.withColumn(text, text_of(text_col)), run, kinds)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **settings)
    out = score(docs, model, id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
