import hashlib
from collections import defaultdict

import numpy as np
from llm_texts import texts_with_everything

from ledgerlens.llm.exact_dedup import Directory, build_directory, drop_copies, exact_dedup


def order(i):
    return (i is not None, i or 0)


def test_equals_brute_force(docs):
    rows = texts_with_everything()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    got = exact_dedup(docs(rows), capacity=200).collect()
    assert len(got) == len(rows)
    for r in got:
        same = [g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        assert len(same) == 1 and r.group_size == len(same[0]) and r.doc_id in same[0]
        assert r.keep_id == max(same[0], key=order)
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert len(kept) == len(groups) == len(set(kept))


def test_dropping_copies_keeps_whole_rows(docs):
    rows = texts_with_everything()
    df = docs(rows)
    got = drop_copies(df, capacity=200)
    assert got.schema.names == df.schema.names
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", i), i, key=order)
    assert {(r.doc_id, r.text) for r in got.collect()} == {(i, t) for t, i in best.items()}


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) as key", "10L as bytes")
    d = build_directory(keys, 500)
    k = np.array([r.key for r in keys.collect()], np.int64)
    load = np.bincount(d.bucket(k), minlength=len(d.buckets))
    assert load.max() * 10 <= 500 and load.sum() == 3000 and len(d.slots) == 1 << d.depth
    # a bucket of one key cannot be split
    one = spark.createDataFrame([(5, 10_000)], "key long, bytes long")
    assert len(build_directory(one, 10).buckets) == 1


def test_directory_slots_follow_key_order():
    d = Directory([(0, 1), (2, 2), (3, 2)])
    assert d.slots.tolist() == [0, 0, 1, 2]
    assert d.bucket(np.array([0, 1 << 62, -(1 << 63), -1], np.int64)).tolist() == [0, 0, 1, 2]


def test_empty_table(docs):
    assert exact_dedup(docs([])).collect() == []
    assert drop_copies(docs([])).collect() == []
