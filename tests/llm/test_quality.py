import math
import random
import zlib

import numpy as np
import pytest
from llm_texts import texts_with_everything

from ledgerlens.llm.quality import CLASS, KINDS, MORE, PASSAGE, WIDTH, Model, attention, features, fit, loss_and_gradient, passages_of, quality, scores, start
from ledgerlens.llm.queries import QUERIES

WORDS = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def some_model(seed=1):
    return Model(None, tuple(p + np.random.default_rng(seed).normal(0, 0.3, p.shape) for p in start(3, 2, 6, 5)))


def cut(text):
    return [text[i : i + PASSAGE] for i in range(0, len(text), PASSAGE)]


def words_of(passage):
    return "".join(chr(b) if b > 127 or chr(b).isalnum() and b < 128 else " " for b in passage.lower()).split(" ")


def test_features_say_what_a_passage_is_made_of():
    text = ("Ab ab, 12!\n" + "été " * 200 + "end end end").encode()
    offsets = np.array([0, len(text)])
    flat = np.frombuffer(text, np.uint8)
    row, begin = passages_of(offsets)
    assert row.tolist() == [0] * len(cut(text)) and begin.tolist() == list(range(0, len(text), PASSAGE))
    x = features(flat, begin, np.minimum(begin + PASSAGE, len(text)))
    for got, passage in zip(x, cut(text)):
        pairs = np.zeros(KINDS * KINDS)
        for a, b in zip(passage, passage[1:]):
            pairs[CLASS[a] * KINDS + CLASS[b]] += 1 / (len(passage) - 1)
        assert np.allclose(got[: KINDS * KINDS], np.sqrt(pairs), atol=1e-6)
        words = [w for w in words_of(passage) if w]
        assert math.isclose((got[KINDS * KINDS : -MORE] ** 2).sum(), 1, rel_tol=1e-5)
        assert np.allclose(got[-MORE:], [len(set(words)) / len(words), sum(a == b for a, b in zip(words, words[1:])) / len(words), sum(map(len, words)) / len(words) / 10, math.log1p(len(words)) / 4, len(passage) / PASSAGE], atol=1e-6)


def test_scores_equal_brute_force():
    model = some_model()
    texts = [(t or "").encode() for _, t in texts_with_everything(n=40)] + [b"long words " * 60_000, b"x" * 700_000]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    got = scores(flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), model)
    w, b, v, g, u, c, bias = model.params
    for text, p in zip(texts, got):
        total, z = 0.0, np.zeros(len(c))
        for passage in cut(text):
            x = features(np.frombuffer(passage, np.uint8), np.array([0]), np.array([len(passage)]))[0].astype(float)
            h = np.tanh(x @ w + b)
            weight = math.exp(sum(math.tanh(float(h @ v[:, k])) / (1 + math.exp(-float(h @ g[:, k]))) * u[k] for k in range(len(u))))
            total, z = total + weight, z + weight * h
        want = 1 / (1 + math.exp(-float((z / total if total else z) @ c) - bias[0]))
        assert abs(p - want) < 1e-4


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    params = some_model().params
    x, bags, y = rng.random((9, WIDTH)).astype(np.float32) * 0.05, np.array([0, 2, 3, 7]), np.array([1.0, 0, 0, 1])
    _, gradient = loss_and_gradient(x, bags, y, params)
    for k, p in enumerate(params):
        for at in ([tuple(rng.integers(0, s) for s in p.shape) for _ in range(6)]):
            moved = []
            for eps in (1e-3, -1e-3):
                q = [r.copy() for r in params]
                q[k][at] += eps
                moved.append(loss_and_gradient(x, bags, y, tuple(q))[0])
            assert abs((moved[0] - moved[1]) / 2e-3 - gradient[k][at]) < 2e-4


def test_held_out_accuracy_on_the_labels_table(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op11_quality"](spark, sf).collect()}
    known = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    rows = [(y, got[i].predicted) for i, y in known if got[i].held_out]
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in got.items())
    assert sum(p for y, p in rows if y) >= 0.99 * sum(y for y, _ in rows)
    assert sum(1 - p for y, p in rows if not y) >= 0.9 * sum(1 - y for y, _ in rows)


def test_one_bad_passage_among_many_is_found_and_attended_to(spark, docs):
    rng = random.Random(1)
    clean = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows, marks, bad = [], [], {}
    for i in range(700):
        parts = [clean(70).ljust(PASSAGE)[:PASSAGE] for _ in range(rng.randint(3, 7))]
        if rng.random() < 0.5:
            bad[i] = rng.randrange(len(parts))
            parts[bad[i]] = " ".join(w.upper() + "!!" for w in clean(70).split()).ljust(PASSAGE)[:PASSAGE]
        rows.append((i, "".join(parts)))
        marks.append((i, int(i not in bad), 0, ""))
    df = docs(rows)
    model = fit(df, labels(spark, marks))
    texts = [t.encode() for _, t in rows]
    p = scores(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), model)
    test = [i for i in range(700) if held(i)]
    assert np.mean([(p[i] >= 0.5) == (i not in bad) for i in test]) > 0.95
    best = {}
    weights = {}
    for r in attention(df, model).collect():
        weights[r.doc_id] = weights.get(r.doc_id, 0) + r.weight
        best[r.doc_id] = max(best.get(r.doc_id, (0, 0)), (r.weight, r.passage))
    assert all(abs(w - 1) < 1e-9 for w in weights.values())
    assert np.mean([best[i][1] == bad[i] for i in test if i in bad]) > 0.9


def test_labels_of_held_out_rows_are_not_learned_and_dealing_changes_nothing(spark, docs):
    rows = [(i, ("BAD!! " if i % 2 else "fine ") * (5 + i % 90)) for i in range(200)]
    marks = [(i, i % 2, 1, "") for i, _ in rows]
    turned = [(i, (1 - y) if held(i) else y, 1, "") for i, y, _, _ in marks]
    a, b = (sorted((r.doc_id, r.score) for r in quality(docs(rows, n), labels(spark, m), rounds=2).collect()) for n, m in ((3, marks), (7, turned)))
    assert [i for i, _ in a] == [i for i, _ in b] and np.allclose([p for _, p in a], [p for _, p in b], atol=1e-7)  # sums of other batches round otherwise


def test_odd_inputs(spark, docs):
    rows = texts_with_everything()
    marks = labels(spark, [(i, i % 3 == 0 and 1 or 0, 1, "") for i in range(100)] + [(5, None, 1, ""), (7, 9, 1, ""), (10**6, 1, 1, ""), (None, 1, 1, "")])
    got = quality(docs(rows), marks, rounds=1, epochs=1).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert len({r.score for r in got if not dict(rows)[r.doc_id]}) == 1  # texts without a passage
    assert quality(docs([]), marks).collect() == []
    none = quality(docs(rows), marks.where("false")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    only = quality(docs(rows), marks.where("quality = 0")).collect()
    assert len({r.score for r in only}) == 1 and {r.predicted for r in only} == {0}


@pytest.mark.parametrize("n", [1, PASSAGE - 1, PASSAGE, PASSAGE + 1, 3 * PASSAGE])
def test_passages_cover_a_text(n):
    row, begin = passages_of(np.array([0, n, n, 2 * n]))
    assert row.tolist() == [0] * (-(-n // PASSAGE)) + [2] * (-(-n // PASSAGE))
    assert begin.tolist() == [*range(0, n, PASSAGE), *range(n, 2 * n, PASSAGE)]
