import itertools
import random

import numpy as np
import pytest
from llm_texts import texts_with_everything

from ledgerlens.llm import jaccard_join
from ledgerlens.llm.common import prime_hashes
from ledgerlens.llm.components import connected_components
from ledgerlens.llm.jaccard_join import jaccard_components, keep_one_of_each, needed, prefix_length

LOW = bytes(range(256)).lower()


def shingles(text):
    w = (text or "").encode().translate(LOW).split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows, threshold=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= threshold * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    names = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            names[find(k)] = min(names.get(find(k), i), i)
    return sorted((str(i), len(s), str(names.get(find(k)) if s else i)) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("seed", [3, 8])
def test_equals_brute_force(docs, seed):
    rows = texts_with_everything(seed, 160)
    got = jaccard_components(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows)


def test_chains_of_links_and_borderline_similarity(docs, monkeypatch):
    # A hot family: every member differs a little more from the first one, so ends link only through the middle.
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in range(i // 4):
            w[k * 2] = f"z{k}"
        rows.append((i + 10, " ".join(w + [f"t{i}"])))
    monkeypatch.setattr(jaccard_join, "LEADERS", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 5)
    got = jaccard_components(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows)


def test_keeping_one_of_each(docs):
    rows = [r for r in texts_with_everything(5, 100)[:-4]]  # without repeated rows and null ids
    df = docs(rows)
    got = keep_one_of_each(df)
    assert got.schema.names == df.schema.names
    # copies have different ids here, so of each component the smallest id stays; empty sets stay
    want = {(int(i), n) for i, n, c in brute(rows) if i == c}
    assert {(r.doc_id, len(shingles(r.text))) for r in got.collect()} == want


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        a = set(rng.choice(1000, n, replace=False).tolist())
        b = set(a)
        for t in list(a)[: int(rng.integers(0, n // 9 + 1))]:
            b.discard(t)
            b.add(int(rng.integers(1000, 2000)))
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            first = [set(sorted(s)[: int(prefix_length(np.array([len(s)]), 80)[0])]) for s in (a, b)]
            assert len(first[0] & first[1]) >= max(needed(len(a), 80), 1) or len(first[0] & first[1]) >= needed(len(b), 80)


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (20, 21), (21, 22), (22, 20), (7, 7)] + [(k, k + 1) for k in range(100, 160)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {5: 3, 4: 3, 3: 3, 9: 3, 20: 20, 21: 20, 22: 20, **{k: 100 for k in range(100, 161)}}


def test_empty_table(docs):
    assert jaccard_components(docs([])).collect() == []
    assert keep_one_of_each(docs([])).collect() == []


def test_regular_words_do_not_collide(docs):
    """The Thue-Morse word over a, b and its complement: alike in every sum modulo 2^64."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << 14))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, word), (4, " ".join([other] * 3)), (5, " ".join([word] * 3))]
    got = {r.doc_id: r.component_id for r in jaccard_components(docs(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_hashes_of_strings_hang_on_their_bytes_alone():
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (1, 2, 3, 700, 1, 65, 40_000)]
    words += [b"\0", b"\0\0", words[3], words[6][:-1]]
    flat = np.frombuffer(b"".join(words), np.uint8)
    stops = np.cumsum([len(w) for w in words])
    alone = [int(prime_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words]
    assert prime_hashes(flat, np.concatenate([[0], stops[:-1]]), stops).tolist() == alone
    assert len(set(alone)) == len(set(words))


def test_components_of_long_chains(spark):
    n = 700
    edges = [(k, k + 1) for k in range(0, n) if k != 333]
    random.Random(3).shuffle(edges)
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: 0 if k <= 333 else 334 for k in range(n + 1)}
