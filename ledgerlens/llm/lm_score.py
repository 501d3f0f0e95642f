"""Language-model scores: marginal likelihood over a subword lattice.

The vocabulary is that of an existing sentencepiece file. A text is a string
of pieces followed by an end event, each drawn independently; its probability
is the sum over every segmentation into pieces. As no piece crosses a blank,
the sum factors into words: each different word's lattice is summed once, by a
forward recursion in log space, and a text's score adds up its words. The words
of a batch are summed together, place by place, in arrays.

Piece probabilities start from the file's own scores (merge order, read as
Zipf ranks) and are fitted by expected counts: forward-backward over all
different training words, weighted with how often they occur, plus the prior.
A character outside the vocabulary is spelled in the file's byte pieces.

Beside it stands the plain word model ("base"): add-one log10 probabilities.

Spark does the counting: words are counted inside tasks, then by a shuffle;
words in at most ``head`` most frequent count classes are sent to all tasks (at
most ``head`` words of at most 64 bytes), and only occurrences of rarer words
are joined with the word table, so no frequent word is ever a join key.

Defined cases: a null or empty text is its end token alone; a null id counts
as the empty id text; repeated rows count again; without training rows N and V
are 0 and the piece prior stands; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored, text_of

#: The end event in word tables; words are never empty.
END = b""
#: Different words that a task counts before it sends them.
COUNTED = 400_000
#: Longest word, in bytes, that is sent to all tasks.
HEAD_BYTES = 64
#: Longest word, in characters, whose lattice is summed together with others.
TOGETHER = 256
#: About how many characters of words are summed together: some 50 MB of arrays.
AT_ONCE = 1 << 17
#: Weight of the prior in the fitted piece counts, in pieces.
PRIOR = 1_000.0


def crc_of(id_col: str, modulus: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


# --- the lattice -----------------------------------------------------------


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[tuple[str, ...], np.ndarray, int]:
    """(pieces, prior log-probabilities with the end event last, first byte
    piece). Control symbols get no probability."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = tuple(model.id_to_piece(i) for i in range(model.get_piece_size()))
    weights = np.zeros(len(pieces) + 1)
    for i in range(len(pieces)):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        rank = len(pieces) if model.is_byte(i) else min(-model.get_score(i), len(pieces))
        weights[i] = 1.0 / (rank + 10.0)
    weights[-1] = 1.0 / 100.0
    first_byte = next(i for i in range(len(pieces)) if model.is_byte(i))
    with np.errstate(divide="ignore"):
        return pieces, np.log(weights / weights.sum()), first_byte


@lru_cache(maxsize=2)
def tree(path: str) -> tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces as a tree of characters, in arrays: (class of each character,
    0 for one in no piece; number of classes; sorted steps, as node * classes +
    class; the node that each step leads to; the piece that ends at each node,
    else -1). The root is node 0."""
    pieces, prior, first_byte = vocabulary(path)
    chars = sorted({ord(char) for piece in pieces for char in piece})
    classes = np.zeros(0x110000, np.int16 if len(chars) < 1 << 15 else np.int32)
    classes[chars] = np.arange(1, len(chars) + 1)
    width = len(chars) + 1
    steps: dict[int, int] = {}
    ends: dict[int, int] = {}
    for number, piece in enumerate(pieces):
        if not np.isfinite(prior[number]) or first_byte <= number < first_byte + 256:
            continue
        node = 0
        for c in classes[[ord(char) for char in piece]].tolist():
            node = steps.setdefault(node * width + c, len(steps) + 1)
        ends[node] = number
    keys = np.array(sorted(steps), np.int32 if (len(steps) + 1) * width < 1 << 31 else np.int64)
    ends_at = np.full(len(steps) + 1, -1, np.int64)
    ends_at[list(ends)] = list(ends.values())
    return classes, width, keys, np.array([steps[k] for k in keys.tolist()], keys.dtype), ends_at


class Lattice:
    """The pieces as a tree of characters, with natural log-probabilities."""

    def __init__(self, path: str, logp: np.ndarray):
        self.path, self.logp = path, logp
        self.first_byte = vocabulary(path)[2]
        self.bytes = [float(x) for x in logp[self.first_byte : self.first_byte + 256]]
        self.end = float(logp[-1])

    @cached_property
    def root(self) -> dict:
        # A node: [its children by character, the log-probability of the piece that ends here, that piece's number]
        root: dict = {}
        for number, piece in enumerate(vocabulary(self.path)[0]):
            if not np.isfinite(self.logp[number]) or self.first_byte <= number < self.first_byte + 256:
                continue
            children, node = root, None
            for char in piece:
                node = children.setdefault(char, [{}, None, 0])
                children = node[0]
            node[1], node[2] = float(self.logp[number]), number
        return root

    def arcs(self, s: str) -> tuple[list[list[tuple]], list[float]]:
        """(arcs, alpha): for each place, the pieces that end there as (start,
        log weight of all ways that end with it, number), and the log of the
        summed probability of all ways to get there. A character that is no
        piece is spelled in bytes (number -1)."""
        root, exp, log = self.root, math.exp, math.log
        n = len(s)
        into: list[list[tuple]] = [[] for _ in range(n + 1)]
        alpha = [0.0] * (n + 1)
        for i in range(n):
            if i:
                ends = into[i]
                if len(ends) == 1:
                    alpha[i] = here = ends[0][1]
                else:
                    top = max(ends, key=_weight)[1]
                    alpha[i] = here = top + log(sum([exp(e[1] - top) for e in ends]))
            else:
                here = 0.0
            children = root
            j = i
            while j < n:
                node = children.get(s[j])
                if node is None:
                    break
                j += 1
                if node[1] is not None:
                    into[j].append((i, here + node[1], node[2]))
                children = node[0]
            first = root.get(s[i])
            if first is None or first[1] is None:
                into[i + 1].append((i, here + sum(self.bytes[b] for b in s[i].encode("utf-8", "surrogatepass")), -1))
        ends = into[n]
        if ends:
            top = max(ends, key=_weight)[1]
            alpha[n] = top + log(sum([exp(e[1] - top) for e in ends]))
        return into, alpha

    def word(self, word: bytes) -> float:
        """Log-probability of a word's marginal, its leading blank included."""
        return self.arcs("▁" + word.decode("utf-8", "replace"))[1][-1]

    def expected(self, word: bytes, times: float, uses: list[float]) -> None:
        """Add the expected number of uses of each piece, ``times`` times: the
        probability mass that flows through each arc, from the end backwards."""
        s = "▁" + word.decode("utf-8", "replace")
        into, alpha = self.arcs(s)
        exp = math.exp
        flow = [0.0] * len(alpha)
        flow[-1] = times
        for j in range(len(s), 0, -1):
            mass, at = flow[j], alpha[j]
            if not mass:
                continue
            for i, weight, number in into[j]:
                share = mass * exp(weight - at)
                flow[i] += share
                if number >= 0:
                    uses[number] += share
                else:
                    for b in s[i].encode("utf-8", "surrogatepass"):
                        uses[self.first_byte + b] += share

    def words(self, words: Sequence[bytes]) -> np.ndarray:
        """``word`` of each word; long ones alone, all others together."""
        out = np.empty(len(words))
        for chosen, texts in self._together(words, out):
            _, _, _, alpha, last = self._sums(texts)
            out[chosen] = alpha[last]
        return out

    def expected_all(self, words: Sequence[bytes], times: np.ndarray, uses: np.ndarray) -> None:
        """``expected`` of each word; long ones alone, all others together."""
        alone = [0.0] * len(uses)
        for chosen, texts in self._together(words, None, times, alone):
            codes, (start, end, number, weight), cuts, alpha, last = self._sums(texts)
            flow = np.zeros(len(alpha))
            flow[last] = times[chosen]
            share = np.exp(weight - alpha[end])
            for a, b in zip(cuts[-2::-1], cuts[:0:-1], strict=True):
                share[a:b] *= flow[end[a:b]]
                flow[start[a:b]] += share[a:b]  # arcs of a word that end at one place start at different ones
            piece = number >= 0
            uses += np.bincount(number[piece], share[piece], len(uses))
            chars, which = np.unique(codes[start[~piece]], return_inverse=True)
            for char, n in zip(chars.tolist(), np.bincount(which, share[~piece], len(chars)).tolist(), strict=True):
                for b in chr(char).encode("utf-8", "surrogatepass"):
                    uses[self.first_byte + b] += n
        uses += alone

    def _together(self, words: Sequence[bytes], out: np.ndarray | None, times: np.ndarray | None = None, uses: list[float] | None = None) -> Iterator[tuple]:
        """(places, spelled words, longest first) of words that are summed
        together, run by run; the long ones are done here."""
        texts = ["▁" + word.decode("utf-8", "replace") for word in words]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        for i in np.flatnonzero(lengths > TOGETHER).tolist():
            if out is not None:
                out[i] = self.word(words[i])
            else:
                self.expected(words[i], float(times[i]), uses)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] <= TOGETHER]
        runs = np.cumsum(lengths[order]) // AT_ONCE
        for chosen in np.split(order, np.flatnonzero(np.diff(runs)) + 1):
            if len(chosen):
                yield chosen, [texts[i] for i in chosen.tolist()]

    def _sums(self, texts: list[str]) -> tuple:
        """The forward recursion of words given longest first. Places are
        numbered place by place over all words, so that those behind a word's
        r-th character are ``row[r]`` + the word's index. Gives (the character
        after each place, arcs as (start, end, number, log weight) by end, cuts
        of the arcs by place in the word, alpha, each word's last place)."""
        classes, width, keys, targets, ends_at = tree(self.path)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        longest = int(lengths[0])
        holds = np.searchsorted(-lengths, -np.arange(longest + 1), "right")  # words with a place r, r = 0 .. longest
        row = np.zeros(longest + 2, np.int64)
        np.cumsum(holds, out=row[1:])
        index = np.repeat(np.arange(len(texts)), lengths)
        place = np.arange(len(index)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        codes = np.full(row[-1], -1, np.int64)
        codes[row[place] + index] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = classes[codes].astype(keys.dtype)
        kinds[codes < 0] = 0  # behind a word's last character: no step
        after = np.arange(row[-1]) + np.repeat(holds, holds)  # the same word's next place

        begin = at = np.flatnonzero(codes >= 0)
        node = np.zeros(len(at), keys.dtype)
        alone = np.ones(row[-1], bool)
        found = []
        while len(at):
            key = node * width + kinds[at]
            step = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            on = np.flatnonzero(keys[step] == key)
            begin, at, node = begin[on], after[at[on]], targets[step[on]]
            number = ends_at[node]
            ends = number >= 0
            if not found:
                alone[begin[ends]] = False
            found.append((begin[ends], at[ends], number[ends]))
        spelled = np.flatnonzero(alone & (codes >= 0))  # by characters that are no piece
        found.append((spelled, after[spelled], np.full(len(spelled), -1, np.int64)))
        start, end, number = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(end, kind="stable")
        start, end, number = start[order], end[order], number[order]
        weight = self.logp[number]
        in_bytes = np.flatnonzero(number < 0)
        chars, which = np.unique(codes[start[in_bytes]], return_inverse=True)
        weight[in_bytes] = np.array([sum(self.bytes[b] for b in chr(char).encode("utf-8", "surrogatepass")) for char in chars.tolist()], float)[which]

        first = np.searchsorted(end, np.arange(row[1], row[-1]))  # every place behind a character has an arc
        cuts = np.append(first[row[1:-1] - row[1]], len(end))
        alpha = np.zeros(row[-1])
        for r in range(1, longest + 1):
            a, b = cuts[r - 1], cuts[r]
            weight[a:b] += alpha[start[a:b]]
            heads = first[row[r] - row[1] : row[r + 1] - row[1]] - a
            top = np.maximum.reduceat(weight[a:b], heads)
            sums = np.add.reduceat(np.exp(weight[a:b] - np.repeat(top, np.diff(heads, append=b - a))), heads)
            alpha[row[r] : row[r + 1]] = top + np.log(sums)
        return codes, (start, end, number, weight), cuts, alpha, row[lengths] + np.arange(len(texts))


def _weight(arc: tuple) -> float:
    return arc[1]


# --- counting --------------------------------------------------------------


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(the different words of binary texts in lower case, with the end event
    last; the words of all texts in order, as numbers of different ones; each
    text's first word, length texts + 1). The end event's uses are not listed."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.view(pa.binary())
    numbers, first = coded.indices.to_numpy(), split.offsets.to_numpy() - split.offsets[0].as_py()
    blank = pc.index(words, pa.scalar(END, pa.binary())).as_py()
    if blank >= 0:  # beside leading and trailing blanks
        keep = numbers != blank
        first = np.concatenate([[0], np.cumsum(keep)])[first]
        numbers = numbers[keep]
        words = pa.concat_arrays([words.slice(0, blank), words.slice(blank + 1)])
        numbers = numbers - (numbers > blank)
    return pa.concat_arrays([words, pa.array([END], pa.binary())]), numbers, first.astype(np.int64)


def listed(words: pa.Array) -> list[bytes]:
    """As ``to_pylist``, which makes a scalar object of each word on the way."""
    return words.to_numpy(zero_copy_only=False).tolist()


def counted_words(batches: Iterator[pa.RecordBatch], most: int = COUNTED) -> Iterator[pa.RecordBatch]:
    """(word, c) of a task's (train, text) rows; a word comes again after more
    than ``most`` different ones."""

    def merged(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])

    held, rows = [], 0
    for batch in batches:
        words, numbers, first = tokens(batch.column(1))
        train = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        c = np.bincount(numbers[np.repeat(train, np.diff(first))], minlength=len(words))
        c[-1] = train.sum()  # the end event
        counts = pa.table([words, pa.array(c, pa.int64())], ["word", "c"])
        held.append(counts if train.any() else counts.slice(0, len(words) - 1))
        rows += held[-1].num_rows
        if rows > 2 * most:
            held = [merged(held)]
            rows = held[0].num_rows
            if rows > most:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from merged(held).to_batches()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c): every different word of all rows with its count in training
    rows, the end event included. ``docs``: (train boolean, text binary)."""
    return map_arrow(docs, counted_words, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def fit_pieces(words: DataFrame, path: str, rounds: int = 2) -> np.ndarray:
    """Piece log-probabilities from the training words and their counts."""
    pieces, prior, _ = vocabulary(path)
    logp = prior
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(logp)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(path, shared.value)  # noqa: B023
            uses = np.zeros(len(pieces) + 1)
            for batch in batches:
                words, c = listed(batch.column(0)), batch.column(1).to_numpy()
                ends = np.fromiter((w == END for w in words), bool, len(words))
                uses[-1] += c[ends].sum()
                lattice.expected_all([w for w in words if w != END], c[~ends].astype(float), uses)
            used = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(uses[used])], ["piece", "n"])

        rows = map_arrow(words.where("c > 0"), run, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # one row per piece
        weights = np.exp(prior) * PRIOR
        for r in rows:
            weights[r.piece] += r.n
        with np.errstate(divide="ignore"):
            logp = np.log(weights / weights.sum())
    return logp


def _bucket() -> Column:
    """Count classes, eight to a doubling."""
    return F.floor(F.log2(F.col("c").cast("double")) * 8)


def head_words(scored: DataFrame, head: int) -> dict[bytes, tuple[int, float]]:
    """The words of the highest count classes that hold at most ``head`` words
    together: word -> (count, log10 probability)."""
    short = scored.where((F.col("c") > 0) & (F.octet_length("word") <= HEAD_BYTES)).withColumn("class", _bucket())
    sizes = sorted(((r["class"], r.n) for r in short.groupBy("class").agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, None
    for level, n in sizes:
        if total + n > head:
            break
        total, least = total + n, level
    if least is None:
        return {}
    rows = short.where(F.col("class") >= least).select("word", "c", "lm").collect()  # at most `head` rows of at most 80 bytes
    return {bytes(r.word): (r.c, r.lm) for r in rows}


# --- scoring ---------------------------------------------------------------


def lm_score(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, modulus: int = 7, remainder: int = 2, head: int = 1 << 18) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    held_out = crc_of(id_col, modulus) == remainder
    counted = stored(count_words(docs.select((~held_out).alias("train"), text_of(text_col).alias("text"))), "lm-counts")
    n, v = counted.where("c > 0").agg(F.sum("c"), F.count("*")).first()
    n, v = int(n or 0), int(v or 0)
    logp = spark.sparkContext.broadcast(fit_pieces(counted, path))

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(path, logp.value)
        for batch in batches:
            words = listed(batch.column(0))
            lm = lattice.words(words)
            lm[[i for i, w in enumerate(words) if w == END]] = lattice.end
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lm / math.log(10), pa.float64())], ["word", "c", "lm"])

    scored = stored(map_arrow(counted, score_words, "word binary, c bigint, lm double"), "lm-words")
    heads = head_words(scored, head)
    numbered = {w: i for i, w in enumerate(heads)}
    values = np.array([(math.log10(c + 1), lm) for c, lm in heads.values()]).reshape(-1, 2)
    frequent = spark.sparkContext.broadcast((numbered, values))

    def score_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered, values = frequent.value
        values = np.vstack([values, np.zeros(2)])  # a rarer word, number -1, adds nothing here
        for batch in batches:
            words, numbers, first = tokens(batch.column(2))
            n = batch.num_rows
            place = np.fromiter(map(numbered.get, listed(words), repeat(-1)), np.int64, len(words))
            text = np.repeat(np.arange(n), np.diff(first))
            hit = place[numbers] >= 0
            known = np.bincount(text[hit], minlength=n) + (place[-1] >= 0)
            sums = np.tile(values[place[-1]], (n, 1))
            some = np.flatnonzero(np.diff(first))
            if len(some):
                for column in range(2):
                    sums[some, column] += np.add.reduceat(values[place, column][numbers], first[some])
            rare = text[~hit] * len(words) + numbers[~hit]
            if place[-1] < 0:
                rare = np.concatenate([rare, np.arange(1, n + 1) * len(words) - 1])
            rare, times = np.unique(rare, return_counts=True)
            offsets = pa.array(np.searchsorted(rare, np.arange(n + 1) * len(words)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (words.take(pa.array(rare % len(words), pa.int64())), pa.array(times, pa.int64()))]
            columns = [pa.array(np.diff(first) + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(sums[:, 0]), pa.array(sums[:, 1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, *lists], ["id", "held_out", "n", "known", "base", "lm", "rare", "times"])

    picked = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), text_of(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    texts = stored(
        map_arrow(picked, score_texts, f"id {kind}, held_out boolean, n bigint, known bigint, base double, lm double, rare array<binary>, times array<bigint>").withColumn(
            "rid", F.monotonically_increasing_id()
        ),
        "lm-texts",
    )
    uses = texts.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("use")).select("rid", F.col("use.rare").alias("word"), F.col("use.times").alias("k"))
    rare = (
        uses.join(scored, "word")
        .groupBy("rid")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known2"),
            F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("base2"),
            F.sum(F.col("k") * F.col("lm")).alias("lm2"),
        )
    )
    nothing = math.log10(n + (v + 1))
    joined = texts.drop("rare", "times").join(rare, "rid", "left")
    return joined.select(
        F.col("id").alias(id_col),
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0)) - F.col("n") * F.lit(nothing)).alias("base_score"),
        (F.col("lm") + F.coalesce("lm2", F.lit(0.0))).alias("score"),
    )
