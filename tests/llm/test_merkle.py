import hashlib
import random
import zlib

import pytest
from llm_texts import texts_with_everything

from ledgerlens.llm.merkle import ARITY, Frontier, fold, levels, manifest, merkle_manifest, run_digest, verified

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in FIELDS)))


def tree(nodes):
    """(root, the siblings of every node, level by level, with the runs they are in)."""
    paths = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        ups, over = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a : a + 3]
            for j in range(len(run)):
                for i in below[a + j]:
                    paths[i].append((j, run))
            ups.append(H(*run))
            over.append([i for j in range(len(run)) for i in below[a + j]])
        nodes, below = ups, over
    return nodes[0], paths


def expected(rows):
    parts = {}
    for r in rows:
        parts.setdefault(r["source"], []).append(r)
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        parts[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = [tree([leaf_of(r) for r in parts[s]]) for s in names]
    root, tops = tree([t[0] for t in trees])
    out = []
    for s, (subroot, paths), top in zip(names, trees, tops):
        for r, path in zip(parts[s], paths):
            whole = path + top
            proof = H(*(d for j, run in whole for k, d in enumerate(run) if k != j))
            wrong = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                wrong["text"] = r["text"].replace("\n", "")
            now = leaf_of(wrong)
            for j, run in whole:
                now = H(*(now if k == j else d for k, d in enumerate(run)))
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, now, now == root))
    return sorted(out, key=repr)


def documents(spark, rows, partitions=3):
    schema = "doc_id long, text string, lang string, source string, n_chars long, k string, digest int, pos string"
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "clash", 7, "x") for r in rows], schema)
    return df.repartition(partitions) if rows else df


def some_rows(n=150):
    rng = random.Random(5)
    sources = ["hot"] * 8 + ["a", "ä", "Z", "", None, "long " * 30]
    texts = texts_with_everything(n=n)
    return [
        {"doc_id": i, "text": t if rng.random() < 0.6 or t is None else t.replace(" ", "\n", 2), "lang": rng.choice(["en", None]), "source": rng.choice(sources), "n_chars": rng.choice([None, len(t or "")])}
        for i, t in texts
    ]


@pytest.mark.parametrize("height", [1, 2, 6])
def test_equals_brute_force(spark, height):
    rows = some_rows()
    got, root = manifest(documents(spark, rows), height=height)
    want = expected(rows)
    assert root.hex() == want[0][3]
    plain = verified(got, root).collect()
    assert all(r.verified for r in plain) and len(plain) == len(rows)
    assert sorted(((r.id, bytes(r.digest).hex(), bytes(r.subroot).hex(), r.proof_sha256) for r in plain), key=repr) == sorted(((w[0], w[1], w[2], w[4]) for w in want), key=repr)


def test_query_equals_brute_force(spark):
    rows = some_rows(90)
    got = merkle_manifest(documents(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    want = expected(rows)
    assert got == want and {w[-1] for w in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 81, 82, 100])
def test_a_frontier_gives_the_tree_and_its_witnesses(n):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    frontier = Frontier()
    for d in digests:
        frontier.append(d)
    root = frontier.close(levels(n))
    want, paths = tree([d.hex() for d in digests])
    assert root.hex() == want
    for i, w in enumerate(frontier.witnesses):
        whole = b"".join(w)
        assert whole.hex() == "".join(d for j, run in paths[i] for k, d in enumerate(run) if k != j)
        assert fold(digests[i], i, n, whole) == (root, len(whole))
        if n > 1:
            assert fold(digests[(i + 1) % n], i, n, whole)[0] != root or n == 1


def test_witnesses_grow_as_siblings_arrive():
    frontier = Frontier()
    digests = [bytes([i]) * 32 for i in range(9)]
    for i, d in enumerate(digests):
        frontier.append(d)
        assert all(len(b"".join(w)) == 64 * (1 + (i == 8)) for w in frontier.witnesses[: (i + 1) // ARITY * ARITY])
    assert b"".join(frontier.witnesses[0]) == digests[1] + digests[2] + run_digest(digests[3:6]) + run_digest(digests[6:9])


@pytest.mark.parametrize("rows", [[], [{"doc_id": 4, "text": "a\nb", "lang": None, "source": None, "n_chars": 3}], [{"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None}] * 2])
def test_small_tables(spark, rows):
    assert sorted((tuple(r) for r in merkle_manifest(documents(spark, rows)).collect()), key=repr) == (expected(rows) if rows else [])


def test_very_long_texts_are_hashed_whole(spark):
    rows = [{"doc_id": i, "text": ("word\n" * 400_000) + end, "lang": "en", "source": "s", "n_chars": 1} for i, end in enumerate(["", "x", "y\n"])]
    got = sorted((tuple(r) for r in merkle_manifest(documents(spark, rows)).collect()), key=repr)
    assert got == expected(rows)


def test_result_does_not_depend_on_the_dealing(spark):
    rows = some_rows(60)
    some = [sorted((tuple(r) for r in merkle_manifest(documents(spark, rows, p)).collect()), key=repr) for p in (1, 7)]
    assert some[0] == some[1]
