import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_texts import texts_with_everything
from tokenizers import Tokenizer

from ledgerlens.llm import packing as P
from ledgerlens.llm.packing import best_fit_packing


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pieces_and_places(docs, byte_bpe, capacity):
    library = Tokenizer.from_file(byte_bpe)
    rows = [r for r in texts_with_everything() if r[0] is not None]
    rows = list(dict(rows).items())  # ids once, so that pieces can be told apart
    got = best_fit_packing(docs(rows), byte_bpe, capacity=capacity).collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == {i for i, _ in rows}
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert sum(r.length for r in own) == len(ids) and all(r.length == capacity for r in own[1:])
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(places) <= math.ceil(1.02 * sum(r.length for r in got) / capacity) + 1


def test_repeated_rows_and_empty_table(docs, byte_bpe):
    got = best_fit_packing(docs([(1, "a b"), (1, "a b"), (None, None)]), byte_bpe).collect()
    assert sorted((str(r.doc_id), r.length) for r in got) == [("1", 3), ("1", 3), ("None", 1)]
    assert len({(r.sequence_id, r.offset) for r in got}) == 3
    assert best_fit_packing(docs([]), byte_bpe).collect() == []


@pytest.mark.parametrize("text", [" " * 1_000_000, "\t" * 1_000_000, "a" + "\n \t" * 400_000 + "b", "word " * 300_000])
def test_long_runs_of_blanks_and_long_texts(docs, byte_bpe, text):
    ids = np.array([*Tokenizer.from_file(byte_bpe).encode(text, add_special_tokens=False).ids, 2], "<u4")
    own = sorted(best_fit_packing(docs([(1, text)]), byte_bpe).collect(), key=lambda r: r.piece)
    assert sum(r.length for r in own) == len(ids)
    assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)


def test_ids_must_follow_the_merges(tmp_path, byte_bpe):
    import json

    with open(byte_bpe, encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["merges"][:2] = spec["model"]["merges"][1::-1]
    path = tmp_path / "turned.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="order of merges"):
        P._encoder(str(path))


def optimum(items, capacity):
    """The fewest sequences, by trying everything."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= items[k] and room not in rooms[:j]:
                go(k + 1, rooms[:j] + [room - items[k]] + rooms[j + 1 :])
        go(k + 1, rooms + [capacity - items[k]])

    go(0, [])
    return best[0]


def test_fixing_dominating_sets_costs_no_sequence():
    rng = random.Random(4)
    for _ in range(150):
        capacity = rng.choice([10, 20])
        items = [rng.randint(2, capacity) for _ in range(rng.randint(1, 9))]
        left = Counter(items)
        fixed = P.reduce_dominated(left, capacity)
        assert all(sum(p) <= capacity for p, _ in fixed)
        rest = list(left.elements())
        assert sum(n for _, n in fixed) + (optimum(rest, capacity) if rest else 0) == optimum(items, capacity)


def test_plans_hold_every_piece():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([10, 50, 100])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 150)))
        got = Counter()
        for pattern, n in P.plan(dict(counts), capacity):
            assert sum(pattern) <= capacity and n > 0
            for length in pattern:
                got[length] += n
        assert got == counts


def test_a_commonplace_length_is_ranked_across_tasks(docs, byte_bpe):
    got = best_fit_packing(docs([(i, "one two") for i in range(500)], 7), byte_bpe, capacity=10).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 500
    assert len({r.sequence_id for r in got}) == math.ceil(500 / 3)


def test_fast_encoder_equals_the_files_own(byte_bpe):
    from test_bpe import odd_texts

    encode, library = P._encoder(byte_bpe), Tokenizer.from_file(byte_bpe)
    for t in odd_texts(800, 9):
        assert encode(t).tolist() == library.encode(t, add_special_tokens=False).ids, t
