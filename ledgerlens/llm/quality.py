"""Document quality: attention-based multiple-instance learning.

A document is a bag of passages, of which only some may show what its label is
about. Every passage (``PASSAGE`` bytes; the last one of a text may be shorter)
is encoded to ``h = tanh(x W + b)`` from what it is made of: pairs of character
classes, hashed words, and how often words repeat. A gated attention,
``exp(u . (tanh(h V) * sigmoid(h G)))``, weighs the passages of a document, the
weighted mean of their encodings represents it, and a logistic function of that
is the score. Labels of documents teach all of it; no passage has a label.

Learning uses about ``max_train`` labelled rows (a documented bound: rows whose
hash of the id falls below a threshold set from their number), each with at most
``max_passages`` passages, evenly spread. ``trainers`` groups learn on their own
rows from the shared parameters, which are then averaged, for ``rounds`` rounds;
groups follow from ids alone, so the model doesn't depend on how rows are dealt.
Scoring is a map over all rows and whole texts: weights are summed up chunk by
chunk, so a text of any length takes the memory of one chunk beside its bytes.

Defined cases: a null or empty text has no passage and is represented by zeros;
labels that are null, neither 0 nor 1, or of unknown documents are not used; of
several labels of one id the larger counts, of several texts of one id that with
the smallest digest is learned from; null ids are held out; without any labelled
training row every score is 0.5, with one class only it is that class's smoothed
share. Repeated rows repeat; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS, binary_view, blank_table, lowered, map_arrow, ship, slices, stored, text_of, word_hashes
from .toxicity import held_out

#: Bytes of a passage; passages that are encoded together.
PASSAGE, CHUNK = 512, 1024
#: Hashed words; further features: share of different words, of words equal to
#: the one before, mean length of words, their number, the passage's length.
BUCKETS, MORE = 1024, 5
_BLANK = blank_table(WORDS)


def _classes() -> np.ndarray:
    """Character classes: small and large letters, digits, blank, line feed,
    other control characters, bytes above 127, and every sign of its own."""
    out = np.zeros(256, np.int64)
    names: dict[str, int] = {}
    for b in range(256):
        c = chr(b)
        kind = "high" if b > 127 else "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c if c in " \n" or b > 32 and b < 127 else "control"
        out[b] = names.setdefault(kind, len(names))
    return out


CLASS = _classes()
KINDS = int(CLASS.max()) + 1
WIDTH = KINDS * KINDS + BUCKETS + MORE


def passages_of(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, first byte) of the passages of texts that lie at ``offsets``."""
    counts = -(-np.diff(offsets) // PASSAGE)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, offsets[:-1][row] + place * PASSAGE


def features(flat: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One row per passage ``flat[starts:stops]``; passages lie side by side."""
    n = len(starts)
    part = flat[starts[0] : stops[-1]]
    sizes = stops - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    which = np.repeat(np.arange(n), sizes)
    kinds = CLASS[part]
    inside = which[1:] == which[:-1]
    pairs = (which[:-1] * (KINDS * KINDS) + kinds[:-1] * KINDS + kinds[1:])[inside]
    out = np.empty((n, WIDTH), np.float32)
    counts = np.bincount(pairs, minlength=n * KINDS * KINDS).reshape(n, -1)
    out[:, : KINDS * KINDS] = counts / np.maximum(sizes - 1, 1)[:, None]
    words, first, begin, end = word_hashes(lowered(part), offsets, _BLANK, places=True)
    number = np.diff(first)
    owner = np.repeat(np.arange(n), number)
    bucket = (words >> np.uint64(54)).astype(np.int64) % BUCKETS
    counts = np.bincount(owner * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, -1)
    some = np.maximum(number, 1)
    out[:, KINDS * KINDS : -MORE] = counts / some[:, None]
    np.sqrt(out[:, :-MORE], out=out[:, :-MORE])
    order = np.lexsort((words, owner))
    w, o = words[order], owner[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    again = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    out[:, -5] = np.bincount(o[new], minlength=n) / some
    out[:, -4] = np.bincount(owner[1:][again], minlength=n) / some
    out[:, -3] = np.bincount(owner, end - begin, n) / some / 10
    out[:, -2] = np.log1p(number) / 4
    out[:, -1] = sizes / PASSAGE
    return out


@dataclass(frozen=True)
class Model:
    prior: float | None  # the score of every text, if there was nothing to learn from
    params: tuple[np.ndarray, ...] = ()  # w, b (encoder), v, g, u (attention), c, bias (score)


def start(pos: int, neg: int, hidden: int, gates: int, seed: int = 5) -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(seed)
    normal = lambda scale, *shape: rng.normal(0, scale, shape)
    return (
        normal(0.5, WIDTH, hidden), np.zeros(hidden), normal(hidden**-0.5, hidden, gates), normal(hidden**-0.5, hidden, gates),
        normal(0.1, gates), normal(0.1, hidden), np.array([np.log(pos / neg)]),
    )


def encode(x: np.ndarray, params: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """(h, tanh gate, sigmoid gate, attention logits) of passages."""
    w, b, v, g, u = params[:5]
    h = np.tanh(x @ w.astype(np.float32) + b)
    t = np.tanh(h @ v)
    s = 1.0 / (1.0 + np.exp(-np.clip(h @ g, -30, 30)))
    return h, t, s, np.clip((t * s) @ u, -30, 30)


def loss_and_gradient(x: np.ndarray, bags: np.ndarray, y: np.ndarray, params: tuple[np.ndarray, ...]) -> tuple[float, list[np.ndarray]]:
    """Log loss of documents and its gradient; ``bags``: the first passage of each."""
    w, b, v, g, u, c, bias = params
    sizes = np.diff(np.append(bags, len(x)))
    h, t, s, logit = encode(x, params)
    weight = np.exp(logit)
    a = weight / np.repeat(np.add.reduceat(weight, bags), sizes)
    z = np.add.reduceat(a[:, None] * h, bags)
    p = 1.0 / (1.0 + np.exp(-np.clip(z @ c + bias[0], -30, 30)))
    d = (p - y) / len(y)
    dz = np.repeat(d[:, None] * c, sizes, axis=0)
    da = (dz * h).sum(1)
    dl = a * (da - np.repeat(np.add.reduceat(a * da, bags), sizes))
    de = dl[:, None] * u
    dt, ds = de * s * (1 - t * t), de * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ v.T + ds @ g.T) * (1 - h * h)
    loss = -float(np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)))
    return loss, [x.T @ dh.astype(np.float32), dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ dl, z.T @ d, np.array([d.sum()])]


def learn(texts: list[bytes], y: np.ndarray, params: tuple[np.ndarray, ...], epochs: int, rate: float, l2: float, batch: int, seed: int) -> tuple[np.ndarray, ...]:
    """Adam over minibatches of documents, from the shared parameters."""
    now = [p.copy() for p in params]
    first, second = [np.zeros_like(p) for p in now], [np.zeros_like(p) for p in now]
    rng = np.random.default_rng(seed)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            flat = np.frombuffer(b"".join(texts[i] for i in chosen), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in chosen])])
            row, begin = passages_of(offsets)
            x = features(flat, begin, np.minimum(begin + PASSAGE, offsets[1:][row]))
            _, gradient = loss_and_gradient(x, np.searchsorted(row, np.arange(len(chosen))), y[chosen], tuple(now))
            gradient[0] = gradient[0] + l2 * now[0]
            step += 1
            for p, d, m, q in zip(now, gradient, first, second, strict=True):
                m += 0.1 * (d - m)
                q += 0.01 * (d * d - q)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.99**step)) + 1e-8)
    return tuple(now)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_train: int, max_passages: int) -> DataFrame:
    """(id, y, text) of the rows to learn from: texts of more passages than
    ``max_passages`` are thinned to that many, evenly spread."""
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    known = stored(known, "quality-labels")
    n = max(1, known.count())
    below = min(1.0, max_train / n)
    while True:
        chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(below * (1 << 30)) + 1))
        if chosen.count() <= 2 * max_train:
            break
        below /= 2
    # At most 2 * max_train pairs of numbers: a proven bound for the broadcast.
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "id").where(F.octet_length("text") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                thin = []
                for text in part.column("text").to_pylist():
                    total = -(-len(text) // PASSAGE)
                    if total > max_passages:
                        at = (np.arange(max_passages) * total // max_passages * PASSAGE).tolist()
                        text = b"".join(text[i : i + PASSAGE].ljust(PASSAGE) for i in at)
                    thin.append(text)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(thin, pa.binary())], ["id", "y", "text"])

    thinned = map_arrow(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, y int, text binary")
    one = F.min(F.struct(F.sha2("text", 256).alias("h"), "y", "text")).alias("row")
    return thinned.groupBy("id").agg(one).select("id", "row.y", "row.text")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = 4_000,
    max_passages: int = 256,
    hidden: int = 24,
    gates: int = 16,
    trainers: int = 6,
    rounds: int = 3,
    epochs: int = 3,
    batch: int = 16,
    rate: float = 0.01,
    l2: float = 1e-5,
) -> Model:
    """Learn the model from the labelled rows that are not held out."""
    sample = _sample(docs, labels, id_col, text_col, label_col, max_train, max_passages)
    train = stored(sample.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(trainers)).cast("int")), "quality-train")
    pos, n = train.agg(F.sum("y"), F.count("*")).first()
    pos, neg = int(pos or 0), int(n) - int(pos or 0)
    if not n:
        return Model(0.5)
    if not pos or not neg:
        return Model((pos + 1) / (n + 2))
    params = start(pos, neg, hidden, gates)
    shards = train.repartitionByRange(trainers, "shard")
    for turn in range(rounds):
        parts = _round(shards, params, (epochs, rate * 0.6**turn, l2, batch, turn))
        total = sum(k for k, _ in parts)
        params = tuple(sum(k * p[i] for k, p in parts) / total for i in range(len(params)))
    return Model(None, params)


def _round(shards: DataFrame, params: tuple[np.ndarray, ...], how: tuple) -> list[tuple[int, list[np.ndarray]]]:
    """(rows, parameters) of each group after learning on its rows."""
    ship(shards.sparkSession)
    shared = shards.sparkSession.sparkContext.broadcast(params)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        learned = learn(group.column("text").to_pylist(), np.array(group.column("y").to_pylist(), np.float64), shared.value, *how)
        flat = [np.ascontiguousarray(p, "<f8").tobytes() for p in learned]
        return pa.table({"n": pa.array([group.num_rows], pa.int64()), "params": pa.array([flat], pa.list_(pa.binary()))})

    got = shards.groupBy("shard").applyInArrow(run, "n bigint, params array<binary>").orderBy("n").collect()  # one row per group
    shared.unpersist()
    return sorted(((r.n, [np.frombuffer(b, "<f8").reshape(p.shape) for b, p in zip(r.params, params, strict=True)]) for r in got), key=lambda r: (r[0], r[1][-1].tolist()))


def weighed(flat: np.ndarray, offsets: np.ndarray, params: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first byte, encodings, unnormed weights) of the passages of texts,
    a chunk at a time."""
    row, begin = passages_of(offsets)
    for a in range(0, len(row), CHUNK):
        rows, starts = row[a : a + CHUNK], begin[a : a + CHUNK]
        h, _, _, logit = encode(features(flat, starts, np.minimum(starts + PASSAGE, offsets[1:][rows])), params)
        yield rows, starts, h, np.exp(logit)


def scores(flat: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    n = len(offsets) - 1
    if model.prior is not None:
        return np.full(n, model.prior)
    c, bias = model.params[5:]
    total, z = np.zeros(n), np.zeros((n, len(c)))
    for rows, _, h, weight in weighed(flat, offsets, model.params):
        total += np.bincount(rows, weight, n)
        cuts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        z[rows[cuts]] += np.add.reduceat(weight[:, None] * h, cuts)
    z /= np.maximum(total, 1e-300)[:, None]
    return 1.0 / (1.0 + np.exp(-np.clip(z @ c + bias[0], -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores(*binary_view(part.column("__text")), shared.value))], [id_col, "score"])

    picked = docs.select(F.col(f"`{id_col}`"), text_of(f"`{text_col}`").alias("__text"))
    return map_arrow(picked, run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, score double")


def attention(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, passage, start, weight): what each passage counts for its document;
    the weights of a document sum up to 1. No rows without anything learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "__text"):
                flat, offsets = binary_view(part.column("__text"))
                some = list(weighed(flat, offsets, m.params)) if m.prior is None else []
                total = sum((np.bincount(r, w, part.num_rows) for r, _, _, w in some), np.zeros(part.num_rows))
                for rows, starts, _, weight in some:
                    at = starts - offsets[rows]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(at // PASSAGE), pa.array(at), pa.array(weight / total[rows])], [id_col, "passage", "start", "weight"])

    picked = docs.select(F.col(f"`{id_col}`"), text_of(f"`{text_col}`").alias("__text"))
    return map_arrow(picked, run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, passage bigint, start bigint, weight double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **settings) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **settings)
    out = score(docs, model, id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
