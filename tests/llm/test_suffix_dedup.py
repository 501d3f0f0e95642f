import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from llm_texts import texts_with_everything

from ledgerlens.llm import suffix_dedup as S


def brute(rows, length):
    order = lambda i: S.LOWEST if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, order(i)), order(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < order(i):
                gone[p : p + length] = True
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((str(i), len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out)


@pytest.mark.parametrize("seed,length", [(3, 50), (4, 50), (5, 24)])
def test_equals_brute_force(docs, seed, length):
    rows = texts_with_everything(seed)
    got = S.suffix_dedup(docs(rows), length=length).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [x[:5] for x in brute(rows, length)]


def test_commonplace_anchors_are_cut_into_blocks(docs, monkeypatch):
    # One passage inside many unlike texts: its edges share anchors in every document.
    rng = random.Random(2)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(14))
    rows = [(i, " ".join(f"{rng.randrange(10**6)}" for _ in range(12)) + " " + passage + " " + str(rng.randrange(10**9)) * 3) for i in range(80)]
    monkeypatch.setattr(S, "SALT", 4)
    got = S.suffix_dedup(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [x[:5] for x in brute(rows, 50)]


def test_cut_anchors_with_the_passage_several_times_in_a_document(docs, monkeypatch):
    rng = random.Random(8)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(11))
    rows = [(i, " ".join(f"{rng.randrange(10**9)} {passage} {rng.randrange(10**9)}" for _ in range(6))) for i in range(12)]
    monkeypatch.setattr(S, "SALT", 12)
    cloudpickle.register_pickle_by_value(S)  # or the workers import the module with its own SALT
    try:
        got = S.suffix_dedup(docs(rows)).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(S)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [x[:5] for x in brute(rows, 50)]


@pytest.mark.parametrize("once,twice", [(1, 2), (2, 1)])
def test_a_passage_whose_end_one_document_repeats(docs, once, twice):
    # The anchor k-gram stands once in one document and doubled in the other.
    rng = random.Random(11)
    text = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    gram = min((text(S.GRAM) for _ in range(5000)), key=lambda g: int(S.mix64(S.rolling_sums(np.frombuffer(g.encode(), np.uint8))[-1:])[0]))
    shared = text(30) + gram
    rows = [(once, text(40) + "1" + shared + "2" + text(40)), (twice, text(40) + "3" + shared + gram + "4" + text(40))]
    got = S.suffix_dedup(docs(rows)).collect()
    want = [x[:5] for x in brute(rows, 50)]
    assert sum(x[2] for x in want) == 50
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_removing_repeats_keeps_rows_and_columns(docs):
    rows = [r for r in texts_with_everything(7)]
    df = docs(rows)
    got = S.remove_repeats(df, chars_col="n_chars")
    assert got.schema.names == df.schema.names
    want = sorted((i, kept.decode("utf-8", "ignore")) for i, *_, kept in brute(rows, 50))
    got = got.collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == want
    assert all(r.n_chars == len(r.text) and r.lang == "en" and r.rid == "x" for r in got)


def test_transform_marks_what_shares_less_than_the_length():
    rng = random.Random(5)
    for _ in range(120):
        length = rng.choice([3, 5, 8])
        contexts = ["".join(rng.choices("abc", k=rng.randint(1, 40))).encode() for _ in range(rng.randint(1, 10))]
        ids = np.array([rng.randint(0, 5) for _ in contexts])
        again, at, _, _ = S.repeated_windows(contexts, ids, length)
        low = {}
        for i, c in enumerate(contexts):
            for p in range(len(c) - length + 1):
                low[c[p : p + length]] = min(low.get(c[p : p + length], 99), ids[i])
        want = {(i, p) for i, c in enumerate(contexts) for p in range(len(c) - length + 1) if ids[i] > low[c[p : p + length]]}
        assert set(zip(again.tolist(), at.tolist(), strict=True)) == want


def test_empty_table(docs):
    assert S.suffix_dedup(docs([])).collect() == []
    assert S.remove_repeats(docs([])).collect() == []


def test_contexts_that_agree_in_48_bits_are_not_taken_for_each_other(docs):
    # 20 bytes in common, no string of 50: nothing goes.
    rows = [(1, "bsaopx tn  aje ptk fp tdyvoqebd e o  kebgs uy d kd"), (2, "fjkxokn oxbex aptk fp tdyvoqebd e o  p nbo tcgxtet")]
    assert [len(t) for _, t in rows] == [50, 50]
    assert {(r.doc_id, r.n_removed, r.n_spans) for r in S.suffix_dedup(docs(rows)).collect()} == {(1, 0, 0), (2, 0, 0)}


def test_anchor_ranges_are_even():
    # Anchors are the smallest hashes of their windows; dealt as they are, most fall into the first ranges.
    rng = np.random.default_rng(4)
    flat = rng.integers(97, 123, 400_000).astype(np.uint8)
    *_, anchor, _ = S.contexts_of(flat, np.array([0, len(flat)]), 50)
    shares = np.bincount((S._spread(anchor) >> np.uint64(59)).astype(np.int64), minlength=32) / len(anchor)
    assert shares.max() < 2 / 32
    assert len(np.unique(S._spread(anchor))) == len(np.unique(anchor))


def test_batches_come_back_in_small_parts(spark, monkeypatch):
    from ledgerlens.llm import common

    batch = pa.RecordBatch.from_arrays([pa.array(range(5000), pa.int64()), pa.array([b"x" * 400] * 4999 + [b"y" * 3_000_000])], ["a", "b"])
    parts = list(common.returned(batch))
    assert pa.Table.from_batches(parts) == pa.Table.from_batches([batch])
    assert max(p.nbytes for p in parts if p.num_rows > 1 and p.column(1)[-1].as_py()[:1] == b"x") <= 2 * common.RETURNED_BYTES
    assert list(common.returned(batch.slice(0, 0)))[0].num_rows == 0
    got = common.map_arrow(spark.range(3).repartition(1), lambda batches: (batch for _ in batches), "a bigint, b binary").selectExpr("count(*) n", "sum(a) s", "sum(length(b)) b").first()
    assert (got.n, got.s, got.b) == (5000, 4999 * 2500, 4999 * 400 + 3_000_000)
