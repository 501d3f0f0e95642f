import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import ann
from ledgerlens.llm.ann import Tree, ann_search
from ledgerlens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)


def exact(rows, queries, k=10):
    """Brute force over usable rows of the usual length."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in queries:
        if q in good:
            near = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            out[q] = near[:k]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def test_recall_on_the_embeddings_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = exact(rows, [i for i, _ in rows if i % 100 == 0])
    got = collected(QUERIES["op2_ann_search"](spark, sf))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    for q, near in got.items():
        assert near == sorted(near)
        for d, i in near:
            a, b = (np.array(rows[x][1], float) for x in (q, i))
            assert rows[q][0] == q and abs(d - float(np.sqrt(((a - b) ** 2).sum()))) < 1e-12


def test_unusable_vectors_ties_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [nan, 1.0]), (400, [inf, 1.0]), (500, [1.0, None]), (600, []), (700, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows += [(1, [1.0, 1.0]), (2, [1.0, -1.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (0, [1.0, 0.0])]
    got = collected(ann_search(frame(spark, rows)))
    assert got == {0: [(1.0, 1), (1.0, 2), (1.0, 3)]}


def test_a_third_of_all_rows_are_one_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    rng = np.random.default_rng(4)
    rows = [(i, ([0.5] * 8 if i % 3 == 0 else rng.normal(size=8).tolist())) for i in range(900)]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    got = collected(ann_search(frame(spark, rows), recall=1.0, leaf_rows=16, is_query=F.col("id") % 50 == 0))
    want = exact(rows, range(0, 900, 50))
    assert set(got) == set(want)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.97 * 10 * len(want)
    for q in want:
        if q % 3 == 0:
            assert got[q] == want[q]  # ten equal vectors with the smallest ids


@pytest.mark.parametrize("times", [1, 4])
def test_a_query_goes_on_until_it_has_k_neighbours(spark, monkeypatch, times):
    # A few rows, repeated under their ids, with a block of their own beside two large groups.
    monkeypatch.setattr(ann, "BLOCK", 50)
    rows = [(i, [1.0, 0.0]) for i in range(600)] + [(i, [-1.5, 0.0]) for i in range(600, 1200)] + [(i, [0.0, 0.5]) for i in range(1200, 1205)] * times
    got = collected(ann_search(frame(spark, rows), leaf_rows=25, is_query=F.col("id") >= 1000))
    assert got == exact(rows, range(1000, 1205))


def test_best_bin_first_visits_every_leaf_once():
    x = np.random.default_rng(1).normal(size=(500, 6))
    tree = Tree(x, branching=4, leaf_rows=20)
    assert sorted(tree.visit(x[3], 10**6)) == list(range(tree.leaves))
    assert tree.visit(x[3], 5) == tree.visit(x[3], 50)[:5]
    leaf = tree.route(x)
    assert sum(tree.visit(v, 1)[0] == n for v, n in zip(x, leaf, strict=True)) > 300


@pytest.mark.parametrize("rows", [[], [(100, None)], [(100, [1.0])]])
def test_nothing_to_find(spark, rows):
    assert ann_search(frame(spark, rows)).collect() == []
