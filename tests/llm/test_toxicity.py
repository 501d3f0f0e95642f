import random
import zlib

import numpy as np
from llm_texts import texts_with_everything

from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.toxicity import drop_toxic, fit, toxicity

WORDS = [f"word{k}" for k in range(60)]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_on_the_labels_table(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, sf).collect()}
    known = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    rows = [(y, got[i].predicted) for i, y in known if got[i].held_out]
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    assert sum(p for y, p in rows if y) >= 0.85 * sum(y for y, _ in rows)
    assert sum(p for y, p in rows if not y) <= 0.01 * sum(1 - y for y, _ in rows)


def test_pairs_that_additive_weights_miss(spark, docs):
    # Toxic only if an insult meets a group: either word alone is clean and as frequent.
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(WORDS, k=12) + ["fool"] * insult + ["tribe"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(insult and group)))
    out = {r.doc_id: r for r in toxicity(docs(rows), labels(spark, marks), rounds=6).collect()}
    test = [(y, out[i].predicted) for i, _, y in marks if held(i)]
    assert np.mean([y == p for y, p in test]) > 0.95


def test_labels_of_held_out_rows_are_not_learned(spark, docs):
    rows = [(i, "fool x" if i % 2 else "fine x") for i in range(300)]
    marks = [(i, 1, i % 2) for i, _ in rows]
    turned = [(i, 1, (1 - y) if held(i) else y) for i, _, y in marks]
    a, b = (sorted((r.doc_id, r.score) for r in toxicity(docs(rows), labels(spark, m)).collect()) for m in (marks, turned))
    assert a == b


def test_odd_inputs(spark, docs):
    rows = texts_with_everything()
    marks = labels(spark, [(i, 1, i % 3 == 0 and 1 or 0) for i in range(100)] + [(5, 1, None), (10**6, 1, 1)])
    got = toxicity(docs(rows), marks).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert toxicity(docs([]), marks).collect() == []
    assert {r.score for r in toxicity(docs(rows), marks.limit(0)).collect()} == {0.0}
    one_class = labels(spark, [(i, 1, 1) for i in range(40)])
    assert len({r.score for r in toxicity(docs(rows), one_class).collect()}) == 1


def test_training_is_bounded(spark, docs):
    model = fit(docs([(i, f"fool w{i % 7} a{i}" if i % 2 else "fine day") for i in range(400)]), labels(spark, [(i, 1, i % 2) for i in range(400)]), max_train=100, max_terms=3)
    assert len(model.keys) <= 3


def test_dropping_toxic_rows_keeps_columns(spark, docs):
    rows = [(i, "you fool" if i % 4 == 0 else "fine day") for i in range(200)]
    df = docs(rows)
    got = drop_toxic(df, labels(spark, [(i, 1, int(i % 4 == 0)) for i, _ in rows]))
    assert got.schema.names == df.schema.names
    assert sorted(r.doc_id for r in got.collect()) == [i for i, _ in rows if i % 4]


def test_one_model_however_the_rows_are_split(spark, docs):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(WORDS, k=9) + ["fool"] * (i % 3 == 0))) for i in range(400)]
    marks = labels(spark, [(i, 1, int(i % 3 == 0)) for i, _ in rows])
    scores = [sorted(map(tuple, toxicity(docs(rows).repartition(n), marks).collect())) for n in (1, 7)]
    assert scores[0] == scores[1]


def test_callers_columns_stay(spark, docs):
    rows = docs([(i, "fool x" if i % 2 else "fine x") for i in range(300)])
    marks = labels(spark, [(i, 1, i % 2) for i in range(300)])
    named = rows.selectExpr("*", "concat('kept ', doc_id) AS __text", "1 AS __y", "2 AS shard")
    kept = drop_toxic(named, marks)
    assert kept.columns == named.columns
    assert sorted(map(tuple, kept.select("doc_id", "__text").collect())) == [(i, f"kept {i}") for i in range(0, 300, 2)]
