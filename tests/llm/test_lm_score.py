import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import texts_with_everything

from ledgerlens.llm.lm_score import Lattice, counted_words, lm_score, vocabulary
from ledgerlens.llm.lm_score import tokens as split_words

LOW = bytes(range(256)).lower()


def tokens(text):
    return [*(text or "").encode().translate(LOW).split(), b""]


def remainder(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


@pytest.mark.parametrize("head", [0, 20, 1 << 18])
def test_base_equals_brute_force(docs, pieces, head):
    rows = texts_with_everything()
    c = Counter()
    for i, t in rows:
        if remainder(i) != 2:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    got = lm_score(docs(rows), pieces, head=head).collect()
    want = []
    for i, t in rows:
        w = tokens(t)
        want.append((str(i), remainder(i) == 2, len(w), sum(c[x] > 0 for x in w), n, round(math.fsum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 for r in got)


def test_scores_do_not_depend_on_how_words_travel(docs, pieces):
    rows = texts_with_everything()
    a, b = (sorted((str(r.doc_id), round(r.score, 6)) for r in lm_score(docs(rows), pieces, head=h).collect()) for h in (0, 1 << 18))
    assert a == b


def test_lattice_sums_all_segmentations(pieces):
    names, prior, first_byte = vocabulary(pieces)
    assert abs(np.exp(prior).sum() - 1) < 1e-9
    lattice = Lattice(pieces, prior)
    usable = {p: prior[i] for i, p in enumerate(names) if np.isfinite(prior[i]) and not first_byte <= i < first_byte + 256}

    def brute(s):
        if not s:
            return 1.0
        total = sum(math.exp(usable[s[:k]]) * brute(s[k:]) for k in range(1, len(s) + 1) if s[:k] in usable)
        if s[0] not in usable:
            total += math.exp(sum(prior[first_byte + b] for b in s[0].encode())) * brute(s[1:])
        return total

    for word in ["the", "river", "été", "x1", "你", "😀a", "tions", "\x01"]:
        assert abs(lattice.word(word.encode()) - math.log(brute("▁" + word))) < 1e-9
        uses = [0.0] * len(prior)
        lattice.expected(word.encode(), 2.0, uses)
        spelled = sum(len(names[i]) * u for i, u in enumerate(uses) if u and not first_byte <= i < first_byte + 256)
        in_bytes = sum(u for i, u in enumerate(uses) if first_byte <= i < first_byte + 256)
        unknown = [ch for ch in "▁" + word if ch not in usable]
        assert abs(spelled + in_bytes - 2.0 * (len(word) + 1 + sum(len(ch.encode()) - 1 for ch in unknown))) < 1e-6


def test_fitting_makes_the_training_texts_likelier(spark, docs, pieces):
    from ledgerlens.llm.lm_score import count_words, fit_pieces
    from pyspark.sql import functions as F

    df = docs([(i, t) for i, t in texts_with_everything() if t]).select(F.lit(True).alias("train"), F.col("text").cast("binary").alias("text"))
    words = count_words(df).cache()
    rows = [(bytes(r.word), r.c) for r in words.collect()]
    totals = []
    for rounds in (0, 1, 2):
        lattice = Lattice(pieces, fit_pieces(words, pieces, rounds))
        totals.append(sum(c * (lattice.word(w) if w else lattice.end) for w, c in rows))
    assert totals[0] < totals[1] < totals[2]


def test_long_words_and_empty_table(docs, pieces):
    (r,) = lm_score(docs([(1, "a" * 20000)]), pieces).collect()
    assert math.isfinite(r.score) and r.n_tokens == 2
    assert lm_score(docs([]), pieces).collect() == []
    (r,) = lm_score(docs([(4, "x")]).where("doc_id = 4"), pieces).collect()
    assert r.n_tokens == 2


def odd_words():
    rng = np.random.default_rng(5)
    words = ["the", "river", "été", "x1", "你好", "😀a", "tions", "\x01", "▁▁a", "\ufffd", "a" * 254, "a" * 255, "a" * 256, "x" * 700]
    return [w.encode() for w in words] + [bytes(rng.integers(33, 256, n, np.uint8)) for n in rng.integers(1, 40, 500)]


@pytest.mark.parametrize("at_once", [1, 900, 1 << 17])
def test_words_summed_together_equal_single_ones(pieces, monkeypatch, at_once):
    monkeypatch.setattr("ledgerlens.llm.lm_score.AT_ONCE", at_once)
    names, prior, _ = vocabulary(pieces)
    lattice, words = Lattice(pieces, prior), odd_words()
    assert np.allclose(lattice.words(words), [lattice.word(w) for w in words], rtol=1e-12, atol=0)
    times, one = np.arange(1.0, len(words) + 1), [0.0] * len(prior)
    for word, n in zip(words, times.tolist(), strict=True):
        lattice.expected(word, n, one)
    together = np.zeros(len(prior))
    lattice.expected_all(words, times, together)
    assert np.allclose(together, one, rtol=1e-9, atol=1e-9)
    assert len(lattice.words([])) == 0


def test_ordinary_words_are_not_summed_one_by_one(pieces, monkeypatch):
    alone = []
    arcs = Lattice.arcs
    monkeypatch.setattr(Lattice, "arcs", lambda self, s: alone.append(len(s)) or arcs(self, s))
    lattice = Lattice(pieces, vocabulary(pieces)[1])
    words = odd_words()
    lattice.words(words)
    lattice.expected_all(words, np.ones(len(words)), np.zeros(len(vocabulary(pieces)[1])))
    assert sorted(alone) == [257, 257, 701, 701]  # with the leading blank


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_counted_words_equal_split(most):
    rng = np.random.default_rng(3)
    letters = np.frombuffer(b" \t\n\x0b\x0c\r\x00\x1c\x85aAbZ\xc2\xa0\xff", np.uint8)
    texts = [b"", b" ", b"A a\x0bB\x0c", bytes(range(256)), *(rng.choice(letters, n).tobytes() for n in rng.integers(0, 30, 200))]
    train = rng.integers(0, 2, len(texts)).astype(bool).tolist()
    words, numbers, first = split_words(pa.array(texts, pa.binary()))
    words = words.to_pylist()
    assert words[-1] == b"" and len(set(words)) == len(words)
    assert [[words[k] for k in numbers[a:b]] for a, b in zip(first, first[1:], strict=False)] == [t.translate(LOW).split() for t in texts]

    want, seen = Counter(), set()
    for t, text in zip(train, texts, strict=True):
        seen.update(text.translate(LOW).split())
        if t:
            want.update(text.translate(LOW).split() + [b""])
    batch = pa.RecordBatch.from_arrays([pa.array(train), pa.array(texts, pa.binary())], ["train", "text"])
    got = Counter()
    for out in counted_words(iter([batch.slice(i, 9) for i in range(0, len(texts), 9)]), most):
        assert out.schema.names == ["word", "c"]
        for word, c in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            got[word] += c
    assert dict(got) == {**dict.fromkeys(seen, 0), **want}
